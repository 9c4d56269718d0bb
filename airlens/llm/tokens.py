"""Token ids of whole texts with a public BPE tokenizer file.

``Encoder`` gives the ids that ``Tokenizer.encode(text,
add_special_tokens=False)`` gives, several times faster: the tokenizer never
merges across ASCII white space, so a text's ids are the concatenation of its
chunks' ids, and the bytes of a chunk's ids are kept. A chunk of ASCII or
Latin-1 letters, digits and punctuation is split by the tokenizer's own pattern
and its pieces go to ``Tokenizer.model``; any other chunk, and any that holds
the string of an added token, goes through the whole tokenizer.

The caches hold at most ``cache_size`` entries each and then take no more,
so memory is bounded; a text's ids never depend on them.
"""

from __future__ import annotations

import re
import string
import threading

import numpy as np

from airlens.llm.common import HELD

ID_DTYPE = "<u2"          # the 49k vocabulary fits 16 bits
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: the split pattern of the tokenizer file, for such characters.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-z0-9à-öø-ÿß]+")


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _bytes_to_unicode() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on, in byte order."""
    keep = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = (b for b in range(256) if b not in keep)
    shifted = {b: chr(256 + k) for k, b in enumerate(rest)}
    return {b: shifted.get(b, chr(b)) for b in range(256)}


class _Pieces(dict):
    """Lower-case piece -> bytes of its ids."""

    def __init__(self, model, size: int):
        self.model, self.size = model, size
        self.alphabet = {ord(bytes([b]).decode("latin-1")): c for b, c in _bytes_to_unicode().items()}

    def __missing__(self, piece: str) -> bytes:
        spelled = piece.encode().decode("latin-1").translate(self.alphabet)
        out = np.array([t.id for t in self.model.tokenize(spelled)], ID_DTYPE).tobytes()
        if len(self) < self.size:
            self[piece] = out
        return out


class _Chunks(dict):
    """UTF-8 chunk without ASCII white space -> bytes of its ids."""

    def __init__(self, tokenizer, size: int):
        self.tokenizer, self.size = tokenizer, size
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        if any(set(t) & set(string.whitespace) for t in added):
            raise ValueError("an added token with white space would span chunks")
        # Case is ignored, as a token may be matched after the normalizer.
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        self.pieces = _Pieces(tokenizer.model, size)
        self.get_piece = self.pieces.__getitem__

    def __missing__(self, raw: bytes) -> bytes:
        chunk = raw.decode()
        if _PLAIN.fullmatch(chunk) and not self.added.search(chunk):
            out = b"".join(map(self.get_piece, _PIECE.findall(chunk.lower())))
        else:
            out = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, ID_DTYPE).tobytes()
        if len(self) < self.size:
            self[raw] = out
        return out


class Encoder:
    def __init__(self, path: str | None = None, cache_size: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_tokenizer_path())
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self.chunks = _Chunks(self.tokenizer, cache_size)
        self.get_chunk = self.chunks.__getitem__

    def encode_bytes(self, text: str | None) -> bytes:
        """Little-endian 16-bit ids; a null text is empty."""
        if not text:
            return b""
        # bytes.split() splits at ASCII white space only.
        return b"".join(map(self.get_chunk, text.encode().split()))

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), ID_DTYPE)


_SHARED: dict[tuple, Encoder] = {}
_LOCK = threading.Lock()


HELD["tokens"] = _SHARED.clear


def shared_encoder(path: str | None = None, cache_size: int = 500_000) -> Encoder:
    """One encoder for a Python worker's tasks."""
    with _LOCK:
        key = (path, cache_size)
        if key not in _SHARED:
            _SHARED[key] = Encoder(path, cache_size)
        return _SHARED[key]
