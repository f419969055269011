"""SHA-256 that can be put down and taken up again in another task.

hashlib's objects cannot leave their process. OpenSSL, which hashlib itself calls, keeps the state in a plain
structure of 112 bytes, and these bytes are all that goes from one task to the next.
"""

from __future__ import annotations

import ctypes
import hashlib
from functools import lru_cache

STATE_BYTES = 112


@lru_cache(1)
def _library() -> ctypes.CDLL:
    import _hashlib  # the library that hashlib is linked with

    library = ctypes.CDLL(_hashlib.__file__)
    for name, second in (("SHA256_Update", ctypes.c_char_p), ("SHA256_Final", None)):
        fn = getattr(library, name)
        fn.argtypes = [ctypes.c_char_p, second, ctypes.c_size_t] if second else [ctypes.c_char_p, ctypes.c_char_p]
    library.SHA256_Init.argtypes = [ctypes.c_char_p]
    return library


@lru_cache(1)
def resumable() -> bool:
    """Whether states can be handed on here: tried out on a text cut in two."""
    try:
        state = advanced(advanced(None, b"a" * 100), b"b" * 100)
        return finished(state) == hashlib.sha256(b"a" * 100 + b"b" * 100).hexdigest()
    except (ImportError, OSError, AttributeError):
        return False


def advanced(state: bytes | None, data: bytes) -> bytes:
    """The state after some more bytes; None is the state before any."""
    context = ctypes.create_string_buffer(state or b"", STATE_BYTES)
    if state is None:
        _library().SHA256_Init(context)
    _library().SHA256_Update(context, data, len(data))
    return context.raw


def finished(state: bytes) -> str:
    """Hex digest of all bytes so far."""
    out = ctypes.create_string_buffer(32)
    _library().SHA256_Final(out, ctypes.create_string_buffer(state, STATE_BYTES))
    return out.raw.hex()
