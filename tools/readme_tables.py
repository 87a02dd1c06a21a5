"""Refresh the generated tables in README.md (coverage, bench results).

Usage: python tools/readme_tables.py [bench.json]
"""

from __future__ import annotations

import io
import json
import os
import re
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def replace(text, tag, body):
    start, end = f"<!-- {tag}:start -->", f"<!-- {tag}:end -->"
    block = f"{start}\n{body.rstrip()}\n{end}"
    if start in text:
        return re.sub(re.escape(start) + ".*?" + re.escape(end), lambda m: block, text, flags=re.S)
    return text.replace(tag.upper() + "_TABLE", block)


def main():
    from tools import coverage
    buf = io.StringIO()
    with redirect_stdout(buf):
        coverage.main()
    path = os.path.join(ROOT, "README.md")
    text = open(path).read()
    text = replace(text, "coverage", buf.getvalue())
    if len(sys.argv) > 1:
        d = json.load(open(sys.argv[1]))
        rows = ["| query | seconds |", "|---|---|"]
        rows += [f"| `{k}` | {v if v is not None else 'failed'} |" for k, v in d["queries"].items()]
        rows.append(f"| **total** | **{d['value']}** |")
        text = replace(text, "bench", "\n".join(rows))
    open(path, "w").write(text)


if __name__ == "__main__":
    main()
