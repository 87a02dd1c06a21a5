"""SHA-256 whose inner state can be kept and taken up again.

``hashlib`` hides the state of a digest, OpenSSL's ``SHA256_CTX`` does not: its
bytes are handed from the task that hashed one part of a file to the task that
hashes the next. The library is the one that ``hashlib`` itself is linked with;
driver and executors must be of one byte order.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from functools import cache


class _Context(ctypes.Structure):
    """``SHA256_CTX`` of <openssl/sha.h>."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("bits", ctypes.c_uint32 * 2), ("data", ctypes.c_uint32 * 16),
                ("num", ctypes.c_uint), ("md_len", ctypes.c_uint)]


@cache
def _crypto() -> ctypes.CDLL:
    import _hashlib
    for path in (getattr(_hashlib, "__file__", None), ctypes.util.find_library("crypto")):
        lib = ctypes.CDLL(path)
        if hasattr(lib, "SHA256_Update"):
            lib.SHA256_Init.argtypes = [ctypes.POINTER(_Context)]
            lib.SHA256_Update.argtypes = [ctypes.POINTER(_Context), ctypes.c_char_p, ctypes.c_size_t]
            lib.SHA256_Final.argtypes = [ctypes.c_char_p, ctypes.POINTER(_Context)]
            return lib
    raise RuntimeError("no libcrypto with SHA256_Update: files that one task may not read whole cannot be hashed")


class Sha256:
    """A digest that begins anew or goes on from the ``state()`` of another."""

    def __init__(self, state: bytes | None = None):
        if state is None:
            self._ctx = _Context()
            _crypto().SHA256_Init(self._ctx)
        else:
            self._ctx = _Context.from_buffer_copy(state)

    def update(self, data: bytes) -> Sha256:
        _crypto().SHA256_Update(self._ctx, data, len(data))
        return self

    def state(self) -> bytes:
        return bytes(self._ctx)

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        _crypto().SHA256_Final(out, _Context.from_buffer_copy(self._ctx))
        return out.raw.hex()
