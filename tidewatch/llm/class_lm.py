"""Language-model scoring with Brown class-based bigrams.

``P(word | previous) = P(class | previous class) * P(word | class)``, mixed
with the smoothed unigram so that no text gets probability zero.

1. Documents are tokenised once, into blocks: local vocabulary, token ids and
   training counts, packed.  The blocks are a table in the shared folder.
2. Word counts: every block sends its distinct words (packed, by hash of the
   word) and gets back the corpus counts.  No vocabulary is held anywhere as
   a whole, and a word costs one entry per block however often it occurs.
3. Exchange clustering: every word with at least ``LEAST`` training tokens is a
   unit of its own; rarer words share ``RARE_UNITS`` units by their last bytes.
   The class of a unit is an entry of a table by hash of the word.  In a round
   every block asks for the classes of its words, as it does for counts, and
   sends back how often its units stand before and after each class; summed,
   this gives the class pairs and moves each unit to the class that gains most
   likelihood, in rounds over alternating halves of the units.
4. Each block is scored with the counts and classes that came back for it.

The model gives the outcomes that the unigram has: every training word, and
one unknown word.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import discard, slices, table, written

CLASSES, ROUNDS, MIX = 64, 10, 0.9
LEAST, RARE_UNITS, SUFFIX_BYTES = 5, 256, 3
#: Rare units per word range; their ranges are -1, -2, ...
RARE_TOGETHER = 16
BLOCK_TOKENS, ROWS, FOLDS, HELD_OUT = 2_000_000, 256, 5, 1
#: Packed words that the blocks ask one word range for; the ranges follow from it.
RANGE_BYTES = 4 << 20
#: The end of a text; words are never empty.
END = b""

BLOCKS = ("block string, doc_ids array<long>, held array<boolean>, sizes array<int>, "
          "ids binary, words binary, counts binary, n_train long")
REPLIES = ("block string, part int, parts int, counts binary, index binary, kinds long, "
           "units binary, unit_tokens binary, rare_tokens array<long>, rare_kinds array<long>")
TRAINED = "block string, seq binary, end long, parts array<int>, sizes array<int>, index binary"
STATES = "part int, classes binary, profile binary, cells binary"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
          "score double")


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


@cache
def _zstd():
    import zstandard
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def _unpack(data: bytes) -> bytes:
    return _zstd()[1].decompress(data)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(_unpack(data), "<u4")


def _pack_numbers(x) -> bytes:
    return _pack(np.asarray(x, "<u4").tobytes())


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(_unpack(data), "<i8")


def _pack_longs(x) -> bytes:
    return _pack(np.asarray(x, "<i8").tobytes())


def _pack_words(words: list[bytes]) -> bytes:
    return _pack(b"\n".join(words))  # words hold no white space


def _words(data: bytes) -> list[bytes]:
    return _unpack(data).split(b"\n")


def blocks_of(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Tokenised blocks of documents (see BLOCKS); written once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        vocabulary: dict[bytes, int] = {END: 0}
        doc_ids, held, sizes, ids = [], [], [], []

        def block() -> pa.RecordBatch:
            flat = np.array(ids, "<u4")
            train = flat[~np.repeat(np.array(held, bool), sizes)]
            counts = np.bincount(train, minlength=len(vocabulary))
            row = [f"{part}-{made}", doc_ids, held, sizes, _pack_numbers(flat),
                   _pack_words(list(vocabulary)), _pack_numbers(counts), len(train)]
            kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()),
                     pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)],
                names=[x.split()[0] for x in BLOCKS.split(", ")])

        for b in slices(batches, ROWS):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = tokens(text)
                for w in found:
                    if w not in vocabulary:
                        vocabulary[w] = len(vocabulary)
                doc_ids.append(doc_id)
                held.append(held_out(doc_id))
                sizes.append(len(found))
                ids.extend(map(vocabulary.__getitem__, found))
                if len(ids) >= block_tokens:
                    yield block()
                    made += 1
                    vocabulary = {END: 0}
                    doc_ids, held, sizes, ids = [], [], [], []
        if doc_ids:
            yield block()

    return written(docs.selectExpr("cast(doc_id as long) as doc_id", "text")
                   .mapInArrow(run, BLOCKS), "lm-blocks")


def _part_of(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(parts)


def _rare_unit(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX_BYTES:]) % RARE_UNITS


def corpus_counts(blocks: DataFrame, parts: int, n_train: int,
                  least: int = LEAST) -> DataFrame:
    """Training counts and unit numbers (from 1 in a word range; 0: a rare word)
    for the words of every block, one row per block and word range (see
    REPLIES).  The first row of a range also has its number of distinct training
    words, its units with counts, and the tokens and kinds of its rare units."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, words, counts in zip(*(c.to_pylist() for c in b.columns)):
                words, counts = _words(words), _numbers(counts)
                part = _part_of(words, parts)
                order = np.argsort(part, kind="stable")
                found, starts = np.unique(part[order], return_index=True)
                rows = []
                for p, at in zip(found.tolist(), np.split(order, starts[1:])):
                    rows.append((p, block, _pack_words([words[i] for i in at.tolist()]),
                                 _pack_numbers(counts[at])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*rows), (
                        pa.int32(), pa.string(), pa.binary(), pa.binary()))],
                    names=["part", "block", "words", "counts"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        total: dict[bytes, int] = {}
        for words, counts in zip(rows["words"], rows["counts"]):
            n = _numbers(counts)
            words = _words(words)
            for i in np.flatnonzero(n).tolist():
                total[words[i]] = total.get(words[i], 0) + int(n[i])
        common = sorted((w for w, n in total.items() if n >= least or w == END),
                        key=lambda w: (-total[w], w))
        number = {w: i for i, w in enumerate(common, 1)}
        rare_tokens, rare_kinds = np.zeros(RARE_UNITS, np.int64), np.zeros(RARE_UNITS, np.int64)
        for w, n in total.items():
            if n < least and w != END:
                unit = _rare_unit(w)
                rare_tokens[unit] += n
                rare_kinds[unit] += 1
        out = []
        for block, words in zip(rows["block"], rows["words"]):
            words = _words(words)
            out.append((block, int(rows["part"].iloc[0]), parts,
                        _pack_numbers([total.get(w, 0) for w in words]),
                        _pack_numbers([number.get(w, 0) for w in words]),
                        None, None, None, None, None))
        out[0] = (*out[0][:5], len(total), _pack_words(common) if common else None,
                  _pack_longs([total[w] for w in common]),
                  rare_tokens.tolist(), rare_kinds.tolist())
        return pd.DataFrame(out, columns=[x.split()[0] for x in REPLIES.split(", ")])

    asked = blocks.select("block", "words", "counts").mapInArrow(
        ask, "part int, block string, words binary, counts binary")
    return written(asked.groupBy("part").applyInPandas(answer, REPLIES), "lm-counts")


@dataclass
class ClassModel:
    """What the driver knows; its size is bounded by RARE_UNITS and CLASSES.  The
    classes of the units stay in a table by word range."""

    table: DataFrame | None        # part, units (words), classes
    rare_class: np.ndarray
    class_tokens: np.ndarray
    class_kinds: np.ndarray
    pairs: np.ndarray              # class bigram counts, previous class first
    n_train: int
    kinds: int
    parts: int
    _read: dict[int, dict[bytes, int]] = field(default_factory=dict)

    @property
    def unit_class(self) -> np.ndarray:
        return np.arange(len(self.pairs))

    def unit_of(self, words: list[bytes]) -> np.ndarray:
        """Where the class of each word stands in ``unit_class``; to look into a
        model, as every word range asked for is read by the driver."""
        out = []
        for w, part in zip(words, _part_of(words, self.parts).tolist()):
            if part not in self._read:
                row = self.table.filter(F.col("part") == part).first()
                self._read[part] = dict(zip(_words(row.units), _numbers(row.classes).tolist())
                                        ) if row else {}
            out.append(self._read[part].get(w, self.rare_class[_rare_unit(w)]))
        return np.array(out, np.int64)

    def transitions(self) -> np.ndarray:
        k = len(self.pairs)
        return (self.pairs + 0.5) / (self.pairs.sum(1, keepdims=True) + 0.5 * k)


def training_blocks(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Training tokens of every block as units (see TRAINED): first its own units
    by word range and number, then the rare ones; written once."""
    got = replies.groupBy("block").agg(
        F.first("parts").alias("n_parts"),
        F.collect_list(F.struct("part", "index")).alias("got"))  # one per word range

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            block, held, sizes, ids, words, parts, got = (c.to_pylist()[0] for c in b.columns)
            words, part = _words(words), _part_of(_words(words), parts)
            order = np.argsort(part, kind="stable")
            index = np.empty(len(words), np.int64)
            index[order] = np.concatenate(
                [_numbers(x["index"]) for x in sorted(got, key=lambda x: x["part"])])
            own = np.lexsort((index, part))
            own = own[index[own] > 0]
            unit = np.empty(len(words), np.int64)
            unit[own] = np.arange(len(own))
            for i in np.flatnonzero(index == 0).tolist():
                unit[i] = len(own) + _rare_unit(words[i])
            seq = unit[_numbers(ids)][~np.repeat(np.array(held, bool), sizes)]
            ranges, n = np.unique(part[own], return_counts=True)
            row = [block, _pack_numbers(seq), int(unit[0]), ranges.tolist(), n.tolist(),
                   _pack_numbers(index[own] - 1)]
            kinds = [pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int32()),
                     pa.list_(pa.int32()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                             names=[x.split()[0] for x in TRAINED.split(", ")])

    return written(blocks.hint("merge").join(got, "block").select(
        "block", "held", "sizes", "ids", "words", "n_parts", "got").mapInArrow(run, TRAINED),
        "lm-train")


def _answers(replies: DataFrame, table: DataFrame) -> DataFrame:
    """``block``, ``part``, ``counts``, ``index`` and the ``classes`` of the units
    among the words, in the order of the unit numbers."""
    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        cls = _numbers(known["classes"].iloc[0]) if len(known) else np.zeros(0, "<u4")
        out = []
        for x in asked["index"]:
            n = np.sort(_numbers(x))
            out.append(cls[n[n > 0] - 1].astype("<u2").tobytes())
        return asked.assign(classes=out)[["block", "part", "counts", "index", "classes"]]

    return replies.select("block", "part", "counts", "index").groupBy("part").cogroup(
        table.select("part", "classes").groupBy("part")).applyInPandas(
        answer, "block string, part int, counts binary, index binary, classes binary")


def _state(trained: DataFrame, replies: DataFrame, table: DataFrame, rare_class: np.ndarray,
           classes: int) -> DataFrame:
    """How often each unit stands before and after each class and itself, and the
    class pairs by word range (see STATES)."""
    width = 2 * classes + 1
    got = _answers(replies, table).groupBy("block").agg(
        F.collect_list(F.struct("part", "classes")).alias("got"))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            seq, end, parts, sizes, index, got = (c.to_pylist()[0] for c in b.columns)
            seq, index = _numbers(seq).astype(np.int64), _numbers(index).astype(np.int64)
            if not len(seq):
                continue
            cls = np.concatenate([*(np.frombuffer(x["classes"], "<u2") for x in sorted(
                got, key=lambda x: x["part"])), rare_class]).astype(np.int64)
            before = np.concatenate([[end], seq[:-1]])  # every text ends with END
            codes = np.concatenate([before * width + cls[seq], seq * width + classes + cls[before],
                                    seq[seq == before] * width + 2 * classes])
            del seq, before
            codes.sort()
            at = np.flatnonzero(np.diff(codes, prepend=-1))
            n, codes = np.diff(at, append=len(codes)), codes[at]
            unit = codes // width
            number = np.concatenate([index, np.arange(RARE_UNITS) % RARE_TOGETHER])
            code = codes + (number[unit] - unit) * width  # ascending in a word range
            rare = np.arange(0, RARE_UNITS, RARE_TOGETHER)
            starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]]) if parts else []
            cuts = np.searchsorted(unit, np.concatenate([starts, len(index) + rare]))
            rows = [(p, _pack_numbers(np.diff(c, prepend=0)), _pack_numbers(x)) for p, c, x in zip(
                [*parts, *(-1 - rare // RARE_TOGETHER).tolist()],
                np.split(code, cuts[1:]), np.split(n, cuts[1:])) if len(c)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*rows), (pa.int32(), pa.binary(),
                                                             pa.binary()))],
                names=["part", "codes", "n"])

    def total(sent: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        cls = _numbers(known["classes"].iloc[0])
        sums = np.zeros(len(cls) * width, np.int64)
        for codes, n in zip(sent["codes"], sent["n"]):
            sums[np.cumsum(_numbers(codes), dtype=np.int64)] += _numbers(n)
        cells = np.zeros((classes, classes), np.int64)
        np.add.at(cells, cls, sums.reshape(-1, width)[:, :classes])
        return pd.DataFrame([(known["part"].iloc[0], known["classes"].iloc[0],
                              _pack_longs(sums), _pack_longs(cells))],
                            columns=[x.split()[0] for x in STATES.split(", ")])

    sent = trained.hint("merge").join(got, "block").select(
        "seq", "end", "parts", "sizes", "index", "got").mapInArrow(
        send, "part int, codes binary, n binary")
    return written(sent.groupBy("part").cogroup(
        table.select("part", "classes").groupBy("part")).applyInPandas(total, STATES), "lm-state")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """Class part of the training log-likelihood (word counts given, it is all that moves)."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(0)).sum() - _xlogx(pairs.sum(1)).sum())


def best_class(mine: int, after: np.ndarray, before: np.ndarray, own: float,
               pairs: np.ndarray) -> int:
    """The class that a unit should be exchanged to, given everything else."""
    return int(best_classes(np.array([mine]), after[None], before[None], np.array([own]),
                            pairs.astype(float))[0])


def best_classes(mine: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray,
                 pairs: np.ndarray) -> np.ndarray:
    """``best_class`` of several units, each as if the others stayed."""
    rows = np.arange(len(mine))
    out, into = after.sum(1), before.sum(1)
    gain = np.zeros(after.shape)

    def add(a: np.ndarray, b: np.ndarray, m: np.ndarray) -> None:
        """Cells towards the classes ``a`` counts; m's first axis is the unit's class."""
        rest = a.copy()
        rest[rows, mine] -= own
        u, j = np.nonzero(rest)
        if not len(u):
            return
        cells, logs = m.T[j], _xlogx(m).T[j]  # without the unit itself:
        e, k = np.arange(len(u)), mine[u]
        cells[e, k] -= a[u, j]
        same = np.flatnonzero(j == k)
        cells[same] -= b[u[same]]
        cells[same, k[same]] += own[u[same]]
        logs[e, k] = _xlogx(cells[e, k])
        logs[same] = _xlogx(cells[same])
        units, first = np.unique(u, return_index=True)
        gain[units] += np.add.reduceat(_xlogx(cells + rest[u, j][:, None]) - logs, first)

    add(after, before, pairs)
    add(before, after, pairs.T)
    d = np.repeat(np.diagonal(pairs)[None], len(mine), 0)
    d[rows, mine] -= after[rows, mine] + before[rows, mine] - own
    after, before = after.copy(), before.copy()
    after[rows, mine] -= own
    before[rows, mine] -= own
    gain += (_xlogx(d + after + before + own[:, None]) + _xlogx(d)
             - _xlogx(d + after) - _xlogx(d + before))
    firsts = np.repeat(pairs.sum(1)[None], len(mine), 0)  # wherever the unit goes
    seconds = np.repeat(pairs.sum(0)[None], len(mine), 0)
    firsts[rows, mine] -= out
    seconds[rows, mine] -= into
    gain -= (_xlogx(firsts + out[:, None]) - _xlogx(firsts)
             + _xlogx(seconds + into[:, None]) - _xlogx(seconds))
    best = np.argmax(gain, 1)
    stay = gain[rows, mine]
    return np.where(gain[rows, best] > stay + 1e-9 * np.abs(stay), best, mine)


def _class_pairs(state: DataFrame, classes: int) -> np.ndarray:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for b in slices(batches, 64):
            for cells in b.column(0).to_pylist():
                total += _longs(cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes * classes)),
                                          pa.array(total)], names=["cell", "n"])

    out = np.zeros(classes * classes)
    for r in (state.select("cells").mapInArrow(run, "cell long, n long").groupBy("cell")
              .agg(F.sum("n").alias("n")).collect()):  # classes * classes numbers
        out[r.cell] = r.n
    return out.reshape(classes, classes)


def _moved(state: DataFrame, pairs: np.ndarray, classes: int, half: int) -> DataFrame:
    """The table of classes after one half of the units moved."""
    width = 2 * classes + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            part, cls, profile = (c.to_pylist()[0] for c in b.columns)
            cls, profile = _numbers(cls).copy(), _longs(profile).reshape(-1, width)
            moving = half + 2 * np.flatnonzero(profile[half::2].any(1))
            for at in range(0, len(moving), 128):
                unit = moving[at:at + 128]
                x = profile[unit].astype(float)
                cls[unit] = best_classes(cls[unit].astype(np.int64), x[:, :classes],
                                         x[:, classes:-1], x[:, -1], pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([_pack_numbers(cls)], pa.binary())],
                names=["part", "classes"])

    return written(state.select("part", "classes", "profile").mapInArrow(
        run, "part int, classes binary"), "lm-classes")


def _rare_classes(table: DataFrame) -> np.ndarray:
    rows = table.filter("part < 0").select("part", "classes").collect()  # RARE_UNITS numbers
    return np.concatenate([_numbers(r.classes) for r in sorted(rows, key=lambda r: -r.part)]
                          ).astype(np.int64)


def _release(spark: SparkSession) -> None:
    """Shuffle files of earlier rounds go when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def exchange(trained: DataFrame, replies: DataFrame, start: DataFrame, classes: int = CLASSES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The table of classes, those of the rare units and the class bigram counts,
    after exchange rounds.

    All units of one half move at once, so a round may lose likelihood; the
    best assignment seen is returned, and rounds stop after two without gain.
    """
    def measured(now: DataFrame):
        rare = _rare_classes(now)
        state = _state(trained, replies, now, rare, classes)
        pairs = _class_pairs(state, classes)
        _release(trained.sparkSession)
        return state, (now, rare, pairs)

    state, best = measured(start)
    pairs, best_value, misses = best[2], likelihood(best[2]), 0
    for r in range(rounds):
        moved = _moved(state, pairs, classes, r % 2)
        discard(state)  # the moved classes are written: nothing reads it again
        state, got = measured(moved)
        pairs, value = got[2], likelihood(got[2])
        if value > best_value + 1e-9 * abs(best_value):
            discard(best[0])
            best, best_value, misses = got, value, 0
        else:
            misses += 1
            if misses == 2:
                break
    discard(state)
    return best


def train(blocks: DataFrame, replies: DataFrame, n_train: int, classes: int = CLASSES,
          rounds: int = ROUNDS) -> ClassModel:
    spark = blocks.sparkSession
    firsts = replies.filter("kinds is not null")
    about = firsts.agg(F.sum("kinds").alias("kinds"), F.max("parts").alias("parts")).first()
    rare_tokens, rare_kinds = np.zeros(RARE_UNITS, np.int64), np.zeros(RARE_UNITS, np.int64)
    for r in (firsts.select(F.posexplode(F.arrays_zip("rare_tokens", "rare_kinds")))
              .groupBy("pos").agg(F.sum("col.rare_tokens").alias("tokens"),
                                  F.sum("col.rare_kinds").alias("kinds")).collect()):
        rare_tokens[r.pos], rare_kinds[r.pos] = r.tokens, r.kinds  # RARE_UNITS rows
    rare = np.arange(RARE_UNITS) % classes
    units = firsts.filter("units is not null").select("part", "units", "unit_tokens")

    def begin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            part, words = (c.to_pylist()[0] for c in b.columns)
            cls = (part + np.arange(len(_words(words)))) % classes
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([_pack_numbers(cls)], pa.binary())],
                names=["part", "classes"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, kinds = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
        for b in slices(batches, 1):
            tokens, cls = (c.to_pylist()[0] for c in b.columns)
            tokens, cls = _longs(tokens), _numbers(cls)
            np.add.at(n, cls, tokens)
            np.add.at(kinds, cls, (tokens > 0).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(classes)), pa.array(n), pa.array(kinds)],
            names=["class", "tokens", "kinds"])

    table, pairs = None, np.zeros((classes, classes))
    class_tokens = np.bincount(rare, rare_tokens, classes)
    class_kinds = np.bincount(rare, rare_kinds, classes)
    if n_train:
        rares = spark.createDataFrame(
            [(-1 - i, bytearray(_pack_numbers(rare[at:at + RARE_TOGETHER])))
             for i, at in enumerate(range(0, RARE_UNITS, RARE_TOGETHER))],
            "part int, classes binary")
        start = written(units.select("part", "units").mapInArrow(
            begin, "part int, classes binary").union(rares), "lm-classes")
        trained = training_blocks(blocks, replies)
        _release(spark)
        table, rare, pairs = exchange(trained, replies, start, classes, rounds)
        table = written(units.join(table, "part"), "lm-units")
        class_tokens = np.bincount(rare, rare_tokens, classes)
        class_kinds = np.bincount(rare, rare_kinds, classes)
        for r in (table.select("unit_tokens", "classes")
                  .mapInArrow(count, "class long, tokens long, kinds long").groupBy("class")
                  .agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).collect()):
            class_tokens[r["class"]] += r.tokens  # one row per class
            class_kinds[r["class"]] += r.kinds
    return ClassModel(table, rare, class_tokens, class_kinds, pairs, n_train, about.kinds or 0,
                      about.parts or 1)


def score_blocks(blocks: DataFrame, replies: DataFrame, model: ClassModel, parts: int,
                 mix: float = MIX) -> DataFrame:
    """Scores of every document (see SCORES)."""
    move, rare_class = model.transitions(), model.rare_class
    space = model.n_train + 0.5 * (model.kinds + 1)
    class_space = model.class_tokens + 0.5 * (model.class_kinds + 1)
    known = replies.withColumn("classes", F.lit(b"")) if model.table is None else _answers(
        replies, model.table)
    answers = known.groupBy("block").agg(F.collect_list(
        F.struct("part", "counts", "index", "classes")).alias("answers"))  # one per word range

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = move @ (0.5 / class_space)
        for b in slices(batches, 1):
            doc_ids, held, sizes, ids, words, got = (c.to_pylist()[0] for c in b.columns)
            words, ids = _words(words), _numbers(ids)
            part = _part_of(words, parts)
            order = np.argsort(part, kind="stable")
            got = sorted(got, key=lambda x: x["part"])
            count, index = np.empty(len(words)), np.empty(len(words), np.int64)
            count[order] = np.concatenate([_numbers(x["counts"]) for x in got])
            index[order] = np.concatenate([_numbers(x["index"]) for x in got])
            own = np.lexsort((index, part))
            own = own[index[own] > 0]
            cls = np.empty(len(words), np.int64)
            cls[own] = np.frombuffer(b"".join(x["classes"] for x in got), "<u2")
            for i in np.flatnonzero(index == 0).tolist():
                cls[i] = rare_class[_rare_unit(words[i])]
            plain = (count + 0.5) / space
            within = (count + 0.5) / class_space[cls]
            now = cls[ids]
            before = np.concatenate([[cls[0]], now[:-1]])  # word 0 is END
            p = np.where(count[ids] > 0, move[before, now] * within[ids], unknown[before])
            p = mix * p + (1 - mix) * plain[ids]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(held, pa.bool_()),
                 pa.array(sizes, pa.int64()),
                 pa.array(np.add.reduceat((count > 0)[ids].astype(np.int64), starts)),
                 pa.array(np.add.reduceat(np.log10(plain)[ids], starts)),
                 pa.array(np.add.reduceat(np.log10(p), starts))],
                names=[x.split()[0] for x in SCORES.split(", ")])

    return blocks.hint("merge").join(answers, "block").select(
        "doc_ids", "held", "sizes", "ids", "words", "answers").mapInArrow(run, SCORES)


def score_documents(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS,
                    mix: float = MIX, block_tokens: int = BLOCK_TOKENS,
                    least: int = LEAST) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` (log10 probabilities).

    * a null text counts as empty: its only token is the end;
    * a null ``doc_id`` counts as the empty text in the hash, which trains;
    * repeated rows all train and each give a row; without training tokens
      every score is zero; other columns are not read; an empty table gives
      no rows;
    * very long texts: a block holds at least one whole text.
    """
    spark = docs.sparkSession
    blocks = blocks_of(docs, block_tokens)
    n_train = blocks.agg(F.sum("n_train")).first()[0] or 0
    asked = blocks.agg(F.sum(F.length("words"))).first()[0] or 0
    parts = max(1, -(-asked // RANGE_BYTES))
    replies = corpus_counts(blocks, parts, n_train, least)
    _release(spark)
    model = train(blocks, replies, n_train, classes, rounds)
    return score_blocks(blocks, replies, model, parts, mix).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long")
        .alias("train_tokens"), "base_score", "score")


def op8_class_lm(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
