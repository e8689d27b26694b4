"""A sha256 that can be handed on: its state between two updates is plain bytes.

``hashlib`` objects cannot be pickled, but the OpenSSL library below them keeps the
state in a flat, public struct (``SHA256_CTX`` of ``openssl/sha.h``).  So one task can
go on where another one stopped.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from functools import cache


class _Context(ctypes.Structure):
    _fields_ = [("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32),
                ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint), ("length", ctypes.c_uint)]


@cache
def _library() -> ctypes.CDLL | None:
    """The OpenSSL that ``hashlib`` is linked with, else the system's; None if there is none."""
    found = []
    try:
        import _hashlib
        found.append(_hashlib.__file__)  # its own symbols and those of the libraries it needs
    except (ImportError, AttributeError):
        pass
    for name in (*found, ctypes.util.find_library("crypto")):
        try:
            lib = ctypes.CDLL(name) if name else None
            if lib is not None:
                lib.SHA256_Init.argtypes = [ctypes.POINTER(_Context)]
                lib.SHA256_Update.argtypes = [ctypes.POINTER(_Context), ctypes.c_void_p, ctypes.c_size_t]
                lib.SHA256_Final.argtypes = [ctypes.c_char_p, ctypes.POINTER(_Context)]
                return lib
        except (OSError, AttributeError):
            continue
    return None


def sha256_goes_on() -> bool:
    """Whether :class:`Sha256` can be used here."""
    return _library() is not None


class Sha256:
    """``Sha256(other.state())`` goes on where ``other`` stopped."""

    def __init__(self, state: bytes | None = None):
        if not sha256_goes_on():
            raise RuntimeError("no OpenSSL library with SHA256_Update was found")
        if state is None:
            self._context = _Context()
            _library().SHA256_Init(self._context)
        else:
            self._context = _Context.from_buffer_copy(state)

    def update(self, data: bytes) -> None:
        _library().SHA256_Update(self._context, data, len(data))

    def update_at(self, address: int, n: int) -> None:
        """``n`` bytes of memory, uncopied."""
        _library().SHA256_Update(self._context, address, n)

    def state(self) -> bytes:
        return bytes(self._context)

    def hexdigest(self) -> str:
        out, context = ctypes.create_string_buffer(32), _Context.from_buffer_copy(self._context)
        _library().SHA256_Final(out, context)
        return out.raw.hex()
