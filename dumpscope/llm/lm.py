"""Language-model scores of whole texts by a weighted backoff automaton that is kept as tables.

Training counts every word, pair and triple of words of the training texts; none is left out, however rare. Probabilities
are discounted counts, and what the discount frees goes to the next lower order. A state is a context of up to two words; its
arcs are the n-grams that go on from there; its failure arc drops the oldest word and weighs the backoff. The state before a word
follows from the two words before it, so a text needs no walk: each of its places is met with the arc that leads on from there.

Texts lie in pieces of some whole texts, as indices into the piece's sorted words. What tasks exchange are blocks of arrays: a
piece gives each bucket its distinct triples with their counts, and the texts they stand in. A bucket has whole words before, so a task
counts their pairs and triples, scores the arcs of both orders, also those that only texts outside the training have, and
sends the sums by text back. Arcs are never gathered on the driver.

A word before with many places is dealt to several buckets by the word before that, so that a context of two words stays whole.
The pairs of such words are counted first and given to each of their buckets.

Places are taken in a fixed number of slices by the word before, one after the other, as the n-grams of all at
once would take many times the texts on disk; a context lies in one slice with all its arcs and those it fails to, so the scores are the same.

A text begins in the state of two beginnings, which gives the same as that of one.

The count of each word of a piece comes back to the piece, in the order of its words. Words and n-grams are told apart by 64-bit hashes.

Null and empty texts have the end token alone. Rows that repeat a ``doc_id`` are trained on and scored each for itself. A
null ``doc_id`` counts as the text ''. Without training texts every token has probability 1. Long texts are
read whole. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.llm.common import (
    WordHash, as_long, bounded_batches, bucketed, crc_remainder, list_column, mix, release, runs, setting, written,
)

FOLDS, HELD_OUT = 5, 1
DISCOUNT = 0.75
#: The end token: no word has a line end in it. Two line ends stand for the beginning as a context.
END = b"\n"
BEGIN = xxhash.xxh3_64_intdigest(b"\n\n")
BITS = np.int64(21)
#: Tokens of a piece, about.
PIECE = 1 << 20
#: Places of a slice in a bucket, about, and the most that a bucket gets of one word before, about.
BUCKET, PART = 1 << 20, 1 << 20
#: Bytes of rows that a task gives to Python at once, about: a piece or some blocks.
BATCH_BYTES = 4 << 20
#: Slices of the places, by the word before, one after the other: what is shuffled of one is dropped before the next.
SLICES = 4
#: Slices go by upper bits; Spark deals partitions by a hash of the whole.
_SLICE_BITS = np.uint64(40)
_PART_BITS = np.uint64(20)

_P1, _P2, _P3, _P4, _P5 = map(
    np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def tokens_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def _flat(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The tokens of all texts and the number of each text's."""
    tokens, lengths = [], []
    for text in texts:
        own = tokens_of(text)
        tokens += own
        lengths.append(len(own))
    return tokens, np.array(lengths, np.int64)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _xxhash64(values: np.ndarray, seed: np.ndarray) -> np.ndarray:
    x = (seed + _P5 + np.uint64(8)) ^ (_turned(values * _P2, 31) * _P1)
    x = _turned(x, 27) * _P1 + _P4
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64`` gives for two long columns."""
    return _xxhash64(right, _xxhash64(left, np.full(1, 42, np.uint64)))


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on, in the fewest bytes each that hold the largest."""
    kind = next(x for x in "BHIQ" if int(values.max(initial=0)) <= np.iinfo(x).max)
    return kind.encode() + values.astype(kind).tobytes()


def _unpacked(data: pa.Buffer) -> np.ndarray:
    return np.frombuffer(data, chr(memoryview(data)[0]), offset=1).astype(np.int64)


def _words(data: pa.Buffer) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct value, and of each value its number among the distinct ones."""
    order = np.argsort(values)
    ordered, new = values[order], np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


BLOCKS = "bucket int, kind int, piece long, data array<binary>"


def _blocks(rows: list[tuple[int, int, int, list[bytes]]]) -> pa.RecordBatch:
    """Rows of ``BLOCKS``: where they go, the order there, the piece they belong to, and arrays as bytes."""
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary()))
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.record_batch(columns, names=["bucket", "kind", "piece", "data"])


def _received(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, int, list[pa.Buffer]]]:
    for batch in batches:
        bucket, kind, piece = (batch.column(c).to_pylist() for c in ("bucket", "kind", "piece"))
        data = batch.column("data")
        for k in range(batch.num_rows):
            yield bucket[k], kind[k], piece[k], [x.as_buffer() for x in data[k].values]


def dealt(blocks: DataFrame, buckets: int) -> DataFrame:
    """Each bucket in a task of its own, in the order of kinds and pieces."""
    return blocks.repartitionById(buckets, "bucket").sortWithinPartitions("kind", "piece")


def tokenised(docs: DataFrame) -> DataFrame:
    """A row for each piece: its sorted words, all its places as indices into them, and of each text tokens, ``held_out`` and ``doc_id``."""
    most = PIECE

    def row(piece: int, some: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]) -> pa.RecordBatch:
        flat, lengths, held = (np.concatenate(x) for x in list(zip(*some, strict=True))[:3])
        words, at = np.unique(flat, return_inverse=True)
        numbers = [piece, len(lengths), len(flat), int(lengths[~held].sum())]
        data = [words.tobytes(), _packed(at), _packed(lengths), _packed(held)]
        ids = list_column(pa.concat_arrays([x[3] for x in some]), np.array([len(lengths)]), pa.int64())
        columns = [*[pa.array([x], pa.int64()) for x in numbers], *[pa.array([x], pa.binary()) for x in data], ids]
        return pa.record_batch(columns, names=["piece", "texts", "places", "train", "words", "at", "lengths", "held", "doc_id"])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, piece, some, size = WordHash(), TaskContext.get().partitionId() << 33, [], 0
        for batch, texts in runs(batches):
            tokens, lengths = _flat(texts)
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            some.append((known.of(tokens), lengths, held, batch.column("doc_id")))
            size += len(tokens)
            if size >= most:
                yield row(piece, some)
                piece, some, size = piece + 1, [], 0
        if some:
            yield row(piece, some)

    schema = "piece long, texts long, places long, train long, words binary, at binary, lengths binary, held binary, doc_id array<long>"
    return docs.select("doc_id", "held_out", "text").mapInArrow(compute, schema)


@dataclasses.dataclass
class Piece:
    """Texts one after the other: sorted hashes of their words, the training count of each, and each place's word among them."""

    number: int
    words: np.ndarray
    counts: np.ndarray
    at: np.ndarray
    lengths: np.ndarray
    held: np.ndarray

    @property
    def train(self) -> np.ndarray:
        return np.repeat(~self.held, self.lengths)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Piece]]:
    """Each row with its arrays; the counts are those that the row has, if any."""
    release()
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            words, at, lengths, held = (row.column(c)[0].as_buffer() for c in ("words", "at", "lengths", "held"))
            counts = [_unpacked(x.as_buffer()) for x in row.column("counts")[0].values] if "counts" in row.schema.names else []
            number, held = row.column("piece")[0].as_py(), _unpacked(held).astype(bool)
            yield row, Piece(number, _words(words), np.concatenate([*counts, np.zeros(0, np.int64)]), _unpacked(at), _unpacked(lengths), held)
    release()


def _places(flat: np.ndarray, lengths: np.ndarray, k: int = 0, of: int = 1) -> tuple[np.ndarray | slice, np.ndarray, np.ndarray, np.ndarray]:
    """The places of slice ``k``, by the word before, and of each the word before the last, the word before, and its own."""
    starts = np.cumsum(lengths) - lengths
    before = np.roll(flat, 1)
    before[starts] = np.uint64(BEGIN)
    first = np.roll(before, 1)
    first[starts] = np.uint64(BEGIN)
    own = np.flatnonzero((before >> _SLICE_BITS) % np.uint64(of) == np.uint64(k)) if of > 1 else slice(None)
    return own, first[own], before[own], flat[own]


def unigrams(tokens: DataFrame, buckets: int) -> DataFrame:
    """The training count of each word of a piece, a row for each bucket of words, in the order of the words.

    ``distinct`` sums up to the number of training words. ``frequent`` are words with ``PART`` places or more, ``places`` how many.
    """
    edges, least = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64), PART

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, p in _pieces(batches):
            n, every = np.bincount(p.at[p.train], minlength=len(p.words)), np.bincount(p.at, minlength=len(p.words))
            stops = [0, *np.searchsorted(p.words, edges).tolist(), len(p.words)]
            spans = [(k, slice(lo, hi)) for k, (lo, hi) in enumerate(zip(stops, stops[1:], strict=False)) if lo < hi]
            yield _blocks([(k, 0, p.number, [p.words[x].tobytes(), _packed(n[x]), _packed(every[x])]) for k, x in spans])

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        asked = [(bucket, piece, _words(words), _unpacked(n), _unpacked(every)) for bucket, _, piece, (words, n, every) in _received(batches)]
        if asked:
            bucket, pieces, words, n, every = zip(*asked, strict=True)
            ends, words = np.cumsum([len(x) for x in words]), np.concatenate(words)
            first, number = _distinct(words)
            n, every = (np.bincount(number, np.concatenate(x)).astype(np.int64) for x in (n, every))
            often = every >= least
            counts = [_packed(x) for x in np.split(n[number], ends[:-1])]
            none = [None] * (len(pieces) - 1)
            columns = [
                pa.array(pieces, pa.int64()), pa.array(bucket, pa.int32()), pa.array(counts, pa.binary()), pa.array([int((n > 0).sum()), *none], pa.int64()),
                pa.array([as_long(words[first[often]]).tolist(), *none], pa.list_(pa.int64())), pa.array([every[often].tolist(), *none], pa.list_(pa.int64())),
            ]
            yield pa.record_batch(columns, names=["piece", "bucket", "counts", "distinct", "frequent", "places"])
        release()

    schema = "piece long, bucket int, counts binary, distinct long, frequent array<long>, places array<long>"
    return dealt(tokens.select("piece", "words", "at", "lengths", "held").mapInArrow(ask, BLOCKS), buckets).mapInArrow(answer, schema)


@dataclasses.dataclass
class Words:
    """Frequent words: sorted hashes, their counts, and ids of those that stand in n-grams (0: none)."""

    hashes: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    core: int
    total: int
    distinct: int
    texts: int

    @property
    def begin(self) -> int:
        """Id of the context at the beginning of a text."""
        return int(self.ids.max(initial=0)) + 1

    def logp(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


@dataclasses.dataclass
class Frequent:
    """Words before that are dealt to several buckets: sorted hashes, and the number of parts of each."""

    hashes: np.ndarray
    parts: np.ndarray

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is one, and its place among them if so."""
        at = np.searchsorted(self.hashes, words)
        at[at == len(self.hashes)] = 0
        return self.hashes[at] == words if len(self.hashes) else np.zeros(len(words), bool), at

    def buckets(self, before: np.ndarray, ab: np.ndarray, buckets: int) -> np.ndarray:
        """The bucket of each place, from the word before and the hash of the two words before."""
        part, (found, at) = np.zeros(len(before), np.uint64), self.find(before)
        part[found] = (ab[found] >> _PART_BITS) % self.parts[at[found]]
        return bucket_of(before, part, buckets)


def bucket_of(words: np.ndarray, part: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(words, part) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def frequent_words(counts: DataFrame, texts: int) -> Frequent:
    """At most one for each ``PART`` places comes to the driver. The beginning stands before as many places as there are texts."""
    rows = counts.where(F.size("frequent") > 0).select(F.explode(F.arrays_zip("frequent", "places")).alias("x")).select("x.*").collect()
    often = sorted([(r.frequent % (1 << 64), r.places) for r in rows] + [(BEGIN, texts)] * (texts >= PART))
    return Frequent(np.array([h for h, _ in often], np.uint64), np.array([-(-n // PART) for _, n in often], np.uint64))


def _arcs(context: np.ndarray, n: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Log-probability of each arc's last word after its ``context``, from the counts ``n`` and the log-probabilities by the lower order.

    An arc that no training text has goes over the failure arc: it weighs what the discounts of the context's arcs free, as a
    share of what the lower order gives to other words.
    """
    first, number = _distinct(context)
    seen, size = n > 0, len(first)
    total, arcs = np.bincount(number, n, size), np.bincount(number[seen], minlength=size)
    given = np.bincount(number[seen], 10.0 ** lower[seen], size)
    free = np.maximum(DISCOUNT * arcs / np.maximum(total, 1), 1e-9)
    backoff = np.where(arcs > 0, np.log10(free / np.maximum(1 - given, 1e-9)), 0.0)
    out = backoff[number] + lower
    out[seen] = np.log10((n[seen] - DISCOUNT) / total[number[seen]])
    return out


def frequent_pairs(pieces: DataFrame, frequent: Frequent, buckets: int) -> DataFrame:
    """Blocks of all pairs after frequent words: the word before, and the words there with counts of the pair and the word."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, p in _pieces(batches):
            _, _, before, here = _places(p.words[p.at], p.lengths)
            own = np.flatnonzero(frequent.find(before)[0])
            if not len(own):
                continue
            b, c = before[own], here[own]
            first, number = _distinct(pair(b, c))
            n, b, c, count = np.bincount(number, p.train[own]).astype(np.int64), b[first], c[first], p.counts[p.at[own[first]]]
            bucket = bucket_of(b, c, buckets)
            order = np.argsort(bucket)
            stops = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            spans = [(k, order[lo:hi]) for k, (lo, hi) in enumerate(zip(stops, stops[1:], strict=False)) if lo < hi]
            yield _blocks([(k, 0, p.number, [b[x].tobytes(), c[x].tobytes(), _packed(count[x]), _packed(n[x])]) for k, x in spans])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        asked = [(_words(b), _words(c), _unpacked(count), _unpacked(n)) for _, _, _, (b, c, count, n) in _received(batches)]
        if asked:
            b, c, count, n = (np.concatenate(x) for x in zip(*asked, strict=True))
            first, number = _distinct(pair(b, c))
            n = np.bincount(number, n).astype(np.int64)
            at = frequent.find(b[first])[1]
            order = np.argsort(at)
            stops = np.searchsorted(at[order], np.arange(len(frequent.hashes) + 1)).tolist()
            for k, (lo, hi) in enumerate(zip(stops, stops[1:], strict=False)):
                if lo < hi:
                    x = first[order[lo:hi]]
                    yield _blocks([(0, 0, k, [b[x[:1]].tobytes(), c[x].tobytes(), _packed(count[x]), _packed(n[order[lo:hi]])])])
        release()

    return dealt(pieces.mapInArrow(ask, BLOCKS), buckets).mapInArrow(count, BLOCKS)


def place_scores(pieces: DataFrame, words: Words, frequent: Frequent, pairs: DataFrame | None, buckets: int, k: int = 0, of: int = 1) -> DataFrame:
    """``piece`` and ``scores``, the sums over the places of slice ``k`` of each text, from all pairs and triples of the slice."""

    def triples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, p in _pieces(batches):
            own, first, before, here = _places(p.words[p.at], p.lengths, k, of)
            if not len(before):
                continue
            train, count = p.train[own], p.counts[p.at[own]]
            text = np.repeat(np.arange(len(p.lengths)), p.lengths)[own]
            ab = pair(first, before)
            gram = pair(ab, pair(before, here))
            bucket = frequent.buckets(before, ab, buckets)
            # By bucket, then by the word before, then by triple; where these bits don't tell two of them apart, one may come twice.
            order = np.argsort((bucket << np.uint64(48)) | ((before >> np.uint64(40)) << np.uint64(24)) | (gram >> np.uint64(40)))
            ordered, text = gram[order], text[order]
            starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            n, ends, at = np.add.reduceat(train[order], starts, dtype=np.int64), np.append(starts, len(order)), order[starts]
            a, b, c, count = first[at], before[at], here[at], count[at]
            stops = np.searchsorted(bucket[at], np.arange(buckets + 1)).tolist()
            rows = []
            for j, (lo, hi) in enumerate(zip(stops, stops[1:], strict=False)):
                if lo < hi:
                    x, heads = slice(lo, hi), lo + np.flatnonzero(np.append(True, b[lo + 1 : hi] != b[lo : hi - 1]))
                    runs_ = [b[heads].tobytes(), _packed(np.diff(heads, append=hi))]
                    grams = [*runs_, a[x].tobytes(), c[x].tobytes(), _packed(count[x]), _packed(n[x]), _packed(np.diff(ends[lo : hi + 1]))]
                    rows += [(j, 1, p.number, grams), (j, 2, p.number, [_packed(text[ends[lo] : ends[hi]])])]
            yield _blocks(rows)

    def repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, at, data in _received(batches):
            b = _words(data[0])
            if (b[0] >> _SLICE_BITS) % np.uint64(of) == np.uint64(k):
                parts = np.arange(frequent.parts[at], dtype=np.uint64)
                block = [x.to_pybytes() for x in data]
                for j in np.unique(bucket_of(np.repeat(b, len(parts)), parts, buckets)).tolist():
                    yield _blocks([(j, 0, at, block)])

    def model(known: list[tuple[np.ndarray, ...]], grams: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """The score of each of the triples, one after the other, from all of a bucket and the pairs of its frequent words."""
        a, b, c, count, n = (np.concatenate(x) for x in zip(*grams, strict=True))
        grams.clear()  # each array is let go as soon as it has been used: a task has many of this length
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        known_b, known_c, known_count, known_n = (np.concatenate(x) for x in zip(*known, empty, strict=True))
        ab, bc = pair(a, b), pair(b, c)
        del a, c
        three, of_three = _distinct(pair(ab, bc))
        n_three, ab, b, bc, count = np.bincount(of_three, n), ab[three], b[three], bc[three], count[three]
        del n, three
        two, of_two = _distinct(np.concatenate([bc, pair(known_b, known_c)]))
        # Triples of a frequent word that lie here are but a part; its pairs have been counted.
        n_two = np.bincount(of_two, np.concatenate([np.where(frequent.find(b)[0], 0, n_three), known_n]))
        one = words.logp(np.concatenate([count, known_count])[two])
        by_two = _arcs(np.concatenate([b, known_b])[two], n_two, one)[of_two[: len(bc)]]
        del two, of_two, n_two, one, b, bc, count
        return _arcs(ab, n_three, by_two)[of_three]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known, grams, spans, places, end, scores, rows = [], [], {}, {}, 0, None, []
        for _, kind, piece, data in _received(batches):
            if kind == 0:
                b, c, count, n = _words(data[0]), _words(data[1]), _unpacked(data[2]), _unpacked(data[3])
                known.append((np.repeat(b, len(c)), c, count, n))
            elif kind == 1:
                b = np.repeat(_words(data[0]), _unpacked(data[1]))
                grams.append((_words(data[2]), b, _words(data[3]), _unpacked(data[4]), _unpacked(data[5])))
                spans[piece], places[piece], end = slice(end, end + len(b)), data[6], end + len(b)
            else:
                if scores is None:
                    scores, known, grams = model(known, grams), [], []
                text = _unpacked(data[0])
                sums = np.bincount(text, np.repeat(scores[spans[piece]], _unpacked(places[piece])))
                present = np.flatnonzero(np.bincount(text))
                rows.append((0, 0, piece, [_packed(present), sums[present].tobytes()]))
                if len(rows) == 64:
                    yield _blocks(rows)
                    rows = []
        if rows:
            yield _blocks(rows)
        release()

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(0)
        row = lambda: pa.record_batch([pa.array([now], pa.int64()), pa.array([sums.tobytes()], pa.binary())], names=["piece", "scores"])
        for _, _, piece, (text, score) in _received(batches):
            if piece != now:
                if now is not None:
                    yield row()
                now, sums = piece, np.zeros(0)
            sums = _added(sums, _unpacked(text), np.frombuffer(score))
        if now is not None:
            yield row()

    blocks = pieces.mapInArrow(triples, BLOCKS)
    if pairs is not None:
        blocks = blocks.unionByName(pairs.mapInArrow(repeated, BLOCKS))
    scores = dealt(blocks, buckets).mapInArrow(score, BLOCKS)
    return scores.repartition("piece").sortWithinPartitions("piece").mapInArrow(summed, "piece long, scores binary")


def _added(sums: np.ndarray, at: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The sums with ``more`` added at places that differ, longer if need be."""
    if len(at) and at[-1] >= len(sums):
        sums = np.append(sums, np.zeros(at[-1] + 1 - len(sums)))
    sums[at] += more
    return sums


def model_scores(pieces: DataFrame, words: Words, frequent: Frequent, buckets: int) -> DataFrame:
    """``piece`` and ``scores``, lists of the sums of log10-probabilities of each text by the trigram model; they add up.

    Each slice is written, and so has its shuffle files dropped, before the next one is run.
    """
    pairs = written(frequent_pairs(pieces, frequent, buckets), "frequent_pairs") if len(frequent.hashes) else None
    parts = [written(place_scores(pieces, words, frequent, pairs, buckets, k, SLICES), "place_scores") for k in range(SLICES)]
    return functools.reduce(DataFrame.unionByName, parts).groupBy("piece").agg(F.collect_list("scores").alias("scores"))


@dataclasses.dataclass
class Automaton:
    """The same model in memory, for texts of few words; tests hold the tables against it.

    State 0 is the empty context, states up to ``words.begin`` are words, the others pairs.

    ``keys`` are arcs, state and word id packed, in ascending order, with log-probability and next state; ``fail`` and ``backoff``
    are each state's failure arc.
    """

    words: Words
    keys: np.ndarray
    logp: np.ndarray
    onto: np.ndarray
    fail: np.ndarray
    backoff: np.ndarray

    def scores(self, ids: np.ndarray, alone: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sum of log10-probabilities of each text, from the word ids of all texts and each word's log-probability by itself."""
        out = np.zeros(len(lengths))
        if not len(lengths):
            return out
        # At each step the texts that go on are the first ones.
        order = np.argsort(-lengths, kind="stable")
        flat, starts, lengths = ids, (np.cumsum(lengths) - lengths)[order], lengths[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
        states, total = np.full(len(starts), self.words.begin), np.zeros(len(starts))
        for step, m in enumerate(active.tolist()):
            at = starts[:m] + step
            word, state = flat[at], states[:m].copy()
            weight, left = np.zeros(m), np.arange(m)
            s, w = state, word
            while True:
                k = np.searchsorted(self.keys, (s << BITS) | w)
                hit = self.keys[k] == (s << BITS) | w
                on, k = left[hit], k[hit]
                weight[on] += self.logp[k]
                state[on] = self.onto[k]
                left, s, w = left[~hit], s[~hit], w[~hit]
                empty = s == 0
                on = left[empty]
                weight[on] += alone[at[on]]
                state[on] = w[empty]
                left, s, w = left[~empty], s[~empty], w[~empty]
                if not len(left):
                    break
                weight[left] += self.backoff[s]
                s = self.fail[s]
            total[:m] += weight
            states[:m] = state
        out[order] = total
        return out


def automaton(words: Words, keys: np.ndarray, counts: np.ndarray) -> Automaton:
    """From the frequent n-grams: discounted probabilities, backoff weights, arcs."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(float)
    mask = (np.int64(1) << BITS) - 1
    pair = keys < (np.int64(1) << (2 * BITS))
    two, n_two, three, n_three = keys[pair], counts[pair], keys[~pair], counts[~pair]
    begin = words.begin
    known = words.ids > 0
    context = np.zeros(begin + 1)
    context[words.ids[known]] = words.counts[known]
    context[begin] = words.texts
    alone = np.zeros(begin + 1)
    alone[words.ids[known]] = 10 ** words.logp(words.counts[known].astype(float))

    def back(state: np.ndarray, p: np.ndarray, lower: np.ndarray, n: int) -> np.ndarray:
        free, rest = np.ones(n), np.ones(n)
        np.subtract.at(free, state, p)
        np.subtract.at(rest, state, lower)
        return np.log10(np.maximum(free, 1e-9) / np.maximum(rest, 1e-9))

    a, b = two >> BITS, two & mask
    p_two = np.maximum(n_two - DISCOUNT, 1e-9) / np.maximum(context[a], n_two)
    back_one = back(a, p_two, alone[b], begin + 1)
    # States of pairs that trigrams go on from. Their counts are those of the pairs: all words have a successor.
    head, c = three >> BITS, three & mask
    pairs = np.unique(head)
    of_pair = np.searchsorted(two, pairs)
    fits = of_pair < len(two)
    fits[fits] = two[of_pair[fits]] == pairs[fits]
    pairs, of_pair = pairs[fits], of_pair[fits]
    where = np.minimum(np.searchsorted(pairs, head), max(len(pairs) - 1, 0))
    ok = pairs[where] == head if len(pairs) else np.zeros(len(head), bool)
    head, c, n_three, where = head[ok], c[ok], n_three[ok], where[ok]
    p_three = np.maximum(n_three - DISCOUNT, 1e-9) / np.maximum(n_two[of_pair[where]], n_three)
    # Probability of c after the second word of the pair alone.
    second = head & mask
    low = np.minimum(np.searchsorted(two, (second << BITS) | c), max(len(two) - 1, 0))
    direct = two[low] == ((second << BITS) | c) if len(two) else np.zeros(len(head), bool)
    lower = np.where(direct, p_two[low] if len(two) else 0.0, 10 ** back_one[second] * alone[c])
    back_two = back(where, p_three, lower, len(pairs))

    def state_of(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        key = (first << BITS) | last
        k = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
        return np.where(pairs[k] == key, begin + 1 + k, last) if len(pairs) else last

    arcs = np.concatenate([two, ((begin + 1 + where) << BITS) | c])
    logp = np.log10(np.concatenate([p_two, p_three]))
    onto = np.concatenate([state_of(a, b), state_of(second, c)])
    order = np.argsort(arcs)
    fail = np.concatenate([np.zeros(begin + 1, np.int64), pairs & mask])
    # A last arc, that of no word, keeps every search inside.
    arcs, logp, onto = np.append(arcs[order], np.iinfo(np.int64).max), np.append(logp[order], 0.0), np.append(onto[order], 0)
    return Automaton(words, arcs, logp, onto, fail, np.concatenate([back_one, back_two]))


def bucket_count(spark: SparkSession, places: int) -> int:
    """By the places, so that a task's arrays stay as large; at most what 16 bits tell apart."""
    return min(1 << 16, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-places // SLICES // BUCKET)))


def scored(docs: DataFrame) -> DataFrame:
    """A row for each document: tokens, known tokens, training tokens, unigram score and model score."""
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES), str(64 << 20)):
        return written(_scored(docs), "document_scores")


def _scored(docs: DataFrame) -> DataFrame:
    own = bounded_batches(docs).select(F.col("doc_id").cast("long"), "text")
    own = own.withColumn("held_out", crc_remainder("doc_id", FOLDS) == HELD_OUT)
    tokens = bucketed(tokenised(own), "tokens", "piece")
    texts, places, train = (x or 0 for x in tokens.agg(F.sum("texts"), F.sum("places"), F.sum("train")).first())
    buckets = bucket_count(docs.sparkSession, places)
    counts = written(unigrams(tokens, buckets), "unigrams")
    none, distinct = np.zeros(0, np.int64), counts.agg(F.sum("distinct")).first()[0] or 0
    words = Words(none, none, none, 0, train, distinct, texts)
    frequent = frequent_words(counts, texts)
    lists = counts.groupBy("piece").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("x"))
    lists = bucketed(lists.select("piece", F.col("x.counts").alias("counts")), "counts", "piece")
    pieces = tokens.join(lists, "piece").select("piece", "words", "at", "lengths", "held", "counts")
    model = model_scores(pieces, words, frequent, buckets)

    def result(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, p in _pieces(batches):
            starts, logp, score = np.cumsum(p.lengths) - p.lengths, words.logp(p.counts.astype(float)), np.zeros(len(p.lengths))
            for x in row.column("scores")[0].values:
                part = np.frombuffer(x.as_buffer())
                score[: len(part)] += part
            columns = [
                row.column("doc_id").flatten(), pa.array(p.held), pa.array(p.lengths),
                pa.array(np.add.reduceat((p.counts > 0)[p.at], starts, dtype=np.int64)), pa.array(np.full(len(starts), train)),
                pa.array(np.add.reduceat(logp[p.at], starts)), pa.array(score),
            ]
            yield pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    whole = tokens.join(lists, "piece").join(model, "piece").select("piece", "words", "at", "lengths", "held", "counts", "doc_id", "scores")
    return whole.mapInArrow(result, schema)
