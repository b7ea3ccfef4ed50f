"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged across:
every merged symbol is a token, so a symbol spanning the pair would contain
it.  Such pairs mark certain cuts.  A text is cut there, each distinct
fragment is encoded once on its own, and the ids are concatenated.

The tokenizer also pre-splits text by a pattern, so a cut is used only where
that pattern gives the same pieces on both sides of it:

* the right side starts a character (never a continuation byte);
* the left character is not white space (the pattern looks ahead at the end
  of a white-space run, so cutting after one could change its last piece);
* no cut before an apostrophe unless an ASCII letter or digit precedes it
  (inside punctuation, a fragment starting with ``'s`` would become a
  contraction that the whole text does not have).

Special tokens are split off first, as the tokenizer does.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, table

VOCABULARY = "byte_bpe_50k.json"
#: A vocabulary file larger than this is refused, so its broadcast is bounded.
MAX_VOCABULARY_BYTES = 64 << 20
#: Distinct fragments kept per Python worker before the cache starts anew.
CACHE_FRAGMENTS = 400_000
ROWS = 256
SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"

#: The pre-splitting that the vocabulary file declares, and its public pattern.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                 "use_regex": True}
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_loaded: dict[int, "ForcedBoundaryBpe"] = {}


def byte_of_symbol() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in byte order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = {}, 256
    for b in range(256):
        if b in printable:
            out[chr(b)] = b
        else:
            out[chr(extra)] = b
            extra += 1
    return out


class ForcedBoundaryBpe:
    """Encoder and decoder over one ``tokenizers`` JSON file of the byte-level kind.

    Its ids equal that library's ``encode(text, add_special_tokens=False)``.
    """

    def __init__(self, source: str, cache_fragments: int = CACHE_FRAGMENTS):
        import tiktoken
        spec = json.loads(source)
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbol = byte_of_symbol()
        vocab = spec["model"]["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)]
                for m in spec["model"]["merges"]]
        if spec["normalizer"] or spec["pre_tokenizer"] != PRE_TOKENIZER or made != sorted(made):
            raise ValueError("not a byte-level vocabulary whose ids are in merge order")
        self._bytes = {i: bytes(symbol[c] for c in t) for t, i in vocab.items()
                       if t not in self._special}
        # ids in merge order are ranks, so fragments can go through the rank encoder
        # (about six times as fast per fragment)
        self._encode = tiktoken.Encoding(
            "fragments", pat_str=PATTERN, special_tokens={},
            mergeable_ranks={b: i for i, b in self._bytes.items()}).encode_ordinary
        self._bytes.update((i, t.encode()) for t, i in self._special.items())
        inside = np.zeros((256, 256), bool)
        for t in self._bytes.values():
            inside[list(t[:-1]), list(t[1:])] = True
        cut = ~inside
        cut[:, 0x80:0xC0] = False
        cut[[0x20, *range(0x09, 0x0E)], :] = False
        alnum = np.zeros(256, bool)
        alnum[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
        cut[~alnum, ord("'")] = False
        self.cut = cut.reshape(-1)
        narrow = cut.copy()
        narrow[0x80:, :] = False  # the left character may be wide white space
        self._narrow = narrow.reshape(-1)
        self._special_split = re.compile(
            "(" + "|".join(re.escape(t) for t in sorted(self._special, key=len, reverse=True)) + ")"
        ) if self._special else None
        self._cache: dict[bytes, bytes] = {}
        self._limit = cache_fragments

    def fragments(self, piece: str) -> list[bytes]:
        raw = piece.encode()
        if len(raw) < 2:
            return [raw] if raw else []
        a = np.frombuffer(raw, np.uint8)
        cut = self._narrow if _WIDE_SPACE.search(piece) else self.cut
        at = np.flatnonzero(cut[(a[:-1].astype(np.uint16) << 8) | a[1:]])
        if not len(at):
            return [raw]
        ends = (at + 1).tolist()
        out = [raw[s:e] for s, e in zip(ends, ends[1:])]
        return [raw[:ends[0]], *out, raw[ends[-1]:]]

    def _known(self, fragment: bytes) -> bytes:
        got = self._cache.get(fragment)
        if got is None:
            if len(self._cache) >= self._limit:
                self._cache.clear()
            ids = self._encode(fragment.decode())
            got = self._cache[fragment] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def encode(self, text: str) -> bytes:
        """Token ids of the whole text as little-endian unsigned 32-bit integers."""
        pieces = self._special_split.split(text) if self._special_split else [text]
        out = []
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(np.array([self._special[piece]], "<u4").tobytes())
                continue
            frags = self.fragments(piece)
            got = list(map(self._cache.get, frags))
            if None in got:
                got = [self._known(f) if g is None else g for f, g in zip(frags, got)]
            out += got
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of the ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        table_ = self._bytes
        return b"".join([table_[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode(
            "utf-8", "replace")


def vocabulary_source(path: str = VOCABULARY) -> str:
    """Content of a vocabulary file; a bare name is looked up among the public tokenizers."""
    if not os.path.dirname(path):
        import public_tokenizers
        path = public_tokenizers.path(path)
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


def _coder(shared) -> ForcedBoundaryBpe:
    """One coder per Python worker and vocabulary, so its cache outlives a task."""
    source = shared.value
    key = hash(source)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ForcedBoundaryBpe(source)
    return _loaded[key]


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Columns: ``doc_id``, ``n_tokens``, ``ids`` (little-endian uint32, packed)
    and ``decoded``.  No shuffle: one pass over the documents.

    * null and empty texts: no ids, empty decoded text;
    * repeated rows: each row gives a row; a null ``doc_id`` is kept;
    * other input columns are not read; an empty table gives no rows;
    * very long texts: memory follows the longest single text.
    """
    source = docs.sparkSession.sparkContext.broadcast(vocabulary_source(vocabulary))

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(source)
        for b in slices(batches, ROWS):
            ids = [coder.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary()),
                 pa.array([coder.decode(i) for i in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(code, SCHEMA)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
