"""Collocations by set-oriented relational mining.

Level k persists a relation of occurrences, sorted by piece and position: where
a frequent phrase of k words begins, and which one.  The next level merge-joins
it with itself on the adjacent position of the same piece, counts the groups
over the corpus, and semi-joins the occurrences with the groups that are
frequent.  The relation lies in units, a row per language and about UNIT_BYTES
of text: a unit joins in place and sends each of its phrases once, packed by
bucket; a bucket adds the units' counts, phrase by phrase (no hash stands for a
phrase), and answers a bit for each.  However often a phrase occurs, it is as
many records as there are units.  Cells are compressed where they are made and
opened where they are read, so files, shuffles and the JVM hold fewer bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import WIDE_ROWS, cut_lineage, mix64, word_hashes

#: bytes of text in a unit; a text is cut between pieces where it would exceed that
UNIT_BYTES = 1 << 24
#: words of text to a bucket, in which phrases are counted
BUCKET_WORDS = 1 << 20
#: shorter cells stay as they are
PACKED_BYTES = 256
LONGEST, NO_LANG = 4, "und"

#: fixed by the contract: ends of pieces, blanks between words
_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_FOLD = bytes(ord(".") if b in _ENDS else ord(" ") if b in _BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))

_UNIT = pa.schema([("unit", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("seq", pa.binary()),
                   ("words", pa.binary()), ("times", pa.binary())])
_UNIT_DDL = "unit long, lang string, n_words long, seq binary, words binary, times binary"
_LEVEL = pa.schema([("unit", pa.int64()), ("gap", pa.binary()), ("phrase", pa.binary()), ("words", pa.binary())])
_LEVEL_DDL = "unit long, gap binary, phrase binary, words binary"


# ------------------------------------------------------------------- cells
def _packed(cell: bytes) -> bytes:
    """The cell compressed, its size in front."""
    return len(cell).to_bytes(8, "little") + (pa.Codec("zstd", 1).compress(cell, asbytes=True) if len(cell) >= PACKED_BYTES else cell)


def _opened(packed: bytes) -> bytes:
    size, body = int.from_bytes(packed[:8], "little"), memoryview(packed)[8:]
    return pa.decompress(body, size, codec="zstd", asbytes=True) if size >= PACKED_BYTES else bytes(body)


def _planes(columns: list[np.ndarray], kind: str = "<i8") -> bytes:
    """The columns' bytes by significance: the compression finds the equal ones."""
    return _packed(b"".join(np.ascontiguousarray(c.astype(kind, copy=False).view(np.uint8).reshape(len(c), -1).T).tobytes()
                            if len(c) else b"" for c in map(np.ascontiguousarray, columns)))


def _columns(planes: bytes, width: int, kind: str = "<i8") -> np.ndarray:
    """One row per record."""
    sheet = np.frombuffer(_opened(planes), np.uint8).reshape(width, np.dtype(kind).itemsize, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(sheet).view(kind)[:, :, 0].T


# ------------------------------------------------------------------- units
class _Numbers(dict):
    """Numbers words in the order in which they are met; 0 ends a piece."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class _Buffer:
    """The words of one language that a task has read since its last unit."""

    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers({b".": 0}), [], 0

    def add(self, folded: bytes) -> None:
        words = (folded.replace(b".", b" . ") + b" .").split()
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(folded)

    def row(self, unit: int, lang: str) -> pa.RecordBatch:
        seq = np.concatenate(self.parts)
        count = np.bincount(seq, minlength=len(self.numbers))[1:]
        columns = [[unit], [lang], [int(count.sum())], [_planes([seq], "<i4")],
                   [_packed(b" ".join(list(self.numbers)[1:]))], [_planes([count])]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _UNIT)], schema=_UNIT)


def _chunks(folded: bytes, limit: int):
    """Runs of whole pieces of about ``limit`` bytes."""
    at = 0
    while at < len(folded):
        cut = folded.find(b".", at + limit - 1) + 1 or len(folded)
        yield folded[at:cut]
        at = cut


def _units(docs: DataFrame, unit_bytes: int) -> DataFrame:
    """Per unit: its words in order as numbers, 0 between pieces, and the words themselves with their counts."""
    def run(batches):
        part, nth, open_, total = TaskContext.get().partitionId(), 0, {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for chunk in _chunks(text.encode().translate(_FOLD), unit_bytes):
                    open_.setdefault(lang, _Buffer()).add(chunk)
                    total += len(chunk)
                    if total >= unit_bytes:
                        for v, b in open_.items():
                            yield b.row((part << 32) | nth, v)
                            nth += 1
                        open_, total = {}, 0
        for v, b in open_.items():
            yield b.row((part << 32) | nth, v)
            nth += 1

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return cut_lineage(rows.mapInArrow(run, _UNIT_DDL), options=WIDE_ROWS)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix64(h) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _dealt(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of records by bucket, and where each bucket begins and ends in it."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return order, cut, np.append(cut[1:], len(order))


# ------------------------------------------------------------------- first level
_WORDS_DDL = "unit long, bucket long, lang string, words binary, times binary"
_KNOWN = pa.schema([("unit", pa.int64()), ("bucket", pa.int64()), ("ranks", pa.binary()), ("lang", pa.string()),
                    ("words", pa.list_(pa.string())), ("f", pa.list_(pa.int64()))])
_KNOWN_DDL = "unit long, bucket long, ranks binary, lang string, words array<string>, f array<long>"
#: an id is its bucket and the word's rank among the bucket's frequent words
_RANK_BITS = 24


def _order_of(words: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word of a unit (a space stands between two), and the words in the order of their buckets."""
    data = np.frombuffer(words, np.uint8)
    blank = np.flatnonzero(data == 0x20)
    start, end = (np.append(0, blank + 1), np.append(blank, len(data))) if len(data) else (blank, blank)
    bucket = _bucket(word_hashes(data, start, end), buckets)
    return bucket, *_dealt(bucket)


def _word_lists(units: DataFrame, buckets: int) -> DataFrame:
    """A unit's distinct words and their counts, dealt into buckets by the word."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                own_words, times = _opened(batch.column(2)[r].as_py()), _columns(batch.column(3)[r].as_py(), 1)[:, 0]
                bucket, order, start, end = _order_of(own_words, buckets)
                words = np.array(own_words.split(), object)
                for x in range(0, len(start), 4096):
                    own = slice(x, x + 4096)
                    at = [order[i:j] for i, j in zip(start[own], end[own])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[r].as_py()] * len(at), pa.int64()), pa.array(bucket[order[start[own]]], pa.int64()),
                        pa.array([batch.column(1)[r].as_py()] * len(at), pa.string()),
                        pa.array([_packed(b" ".join(words[i])) for i in at], pa.binary()),
                        pa.array([_planes([times[i]]) for i in at], pa.binary())],
                        names=["unit", "bucket", "lang", "words", "times"])

    return units.select("unit", "lang", "words", "times").mapInArrow(run, _WORDS_DDL)


def _known_words(lists: DataFrame, least: int) -> DataFrame:
    """For each list of a unit the ranks of its words in the bucket (0: not frequent);
    and, once per bucket and language, the frequent words in the order of their ranks."""
    def run(rows: pa.Table) -> pa.Table:
        langs = rows.column("lang").to_pylist()
        numbers: dict[tuple[str, bytes], int] = {}
        which = [[numbers.setdefault((v, w), len(numbers)) for w in _opened(ws).split()]
                 for v, ws in zip(langs, rows.column("words").to_pylist())]
        times = [_columns(t, 1)[:, 0] for t in rows.column("times").to_pylist()]
        total = np.zeros(len(numbers), np.int64)
        for i, t in zip(which, times):
            total[i] += t  # a list's words are distinct
        rank = np.where(total >= least, np.cumsum(total >= least), 0)
        bucket = rows.column("bucket")[0].as_py() if rows.num_rows else 0
        out = [(u, bucket, rank[i].astype("<i4").tobytes(), None, None, None)
               for u, i in zip(rows.column("unit").to_pylist(), which) if rank[i].any()]
        kept = {}
        for (v, w), r, f in zip(numbers, rank.tolist(), total.tolist()):
            if r:
                kept.setdefault(v, []).append((r, w.decode(), f))
        # the rank goes with the word: (bucket, rank) is its id
        out += [(r, bucket, None, v, [w], [f]) for v, found in kept.items() for r, w, f in found]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 6, _KNOWN)], schema=_KNOWN)

    return cut_lineage(lists.groupBy("bucket").applyInArrow(run, _KNOWN_DDL), shrink=2)


def _first_level(units: DataFrame, known: DataFrame, buckets: int) -> DataFrame:
    """Occurrences of frequent words: the step to the next (1 adjacent, 2 not), and which word."""
    def run(unit: pa.Table, found: pa.Table) -> pa.Table:
        ranks = dict(zip(found.column("bucket").to_pylist(), found.column("ranks").to_pylist()))
        out = []
        for r in range(unit.num_rows):
            bucket, order, start, end = _order_of(_opened(unit.column("words")[r].as_py()), buckets)
            ids = np.full(len(bucket) + 1, -1, np.int64)  # of number i + 1: place i of the word list
            for x, y in zip(start.tolist(), end.tolist()):
                b = int(bucket[order[x]])
                if b in ranks:
                    rank = np.frombuffer(ranks[b], "<i4").astype(np.int64)
                    ids[order[x:y] + 1] = np.where(rank > 0, (b << _RANK_BITS) | rank, -1)
            local = np.where(ids >= 0, np.cumsum(ids >= 0) - 1, -1).astype(np.int32)
            word = local[_columns(unit.column("seq")[r].as_py(), 1, "<i4")[:, 0]]
            at = np.flatnonzero(word >= 0)
            if len(at):
                out.append(_level_row(unit.column("unit")[r].as_py(), at, word[at], ids[ids >= 0][:, None]))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, _LEVEL)], schema=_LEVEL)

    answers = known.where(F.col("ranks").isNotNull()).select("unit", "bucket", "ranks")
    rows = units.select("unit", "seq", "words")
    return cut_lineage(rows.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(run, _LEVEL_DDL), shrink=2, options=WIDE_ROWS)


# ------------------------------------------------------------------- further levels
def _level_row(unit: int, at: np.ndarray, phrase: np.ndarray, words: np.ndarray) -> tuple:
    gap = np.minimum(np.diff(at, append=at[-1:] + 2), 2).astype(np.uint8)
    return unit, _packed(gap.tobytes()), _planes([phrase], "<i4"), _planes([*words.T])


class _Joined:
    """A unit's relation of phrases of k words, merge-joined with itself on the
    next position: the distinct phrases of k + 1 words and where they occur."""

    def __init__(self, k: int, gap: bytes, phrase: bytes, words: bytes):
        gap = np.frombuffer(_opened(gap), np.uint8)
        known, self.words = _columns(phrase, 1, "<i4")[:, 0], _columns(words, k)
        self.at = np.cumsum(np.append(np.zeros(1, np.uint8), gap[:-1]), dtype=np.int32)[:len(gap)]  # of the unit's words
        self.left = np.flatnonzero(gap[:-1] == 1)
        many = max(len(self.words), 1)
        code = known[self.left].astype(np.int64) * many + known[self.left + 1]
        self.code, self.which, self.n = np.unique(code, return_inverse=True, return_counts=True)
        self.phrases = np.column_stack([self.words[self.code // many], self.words[self.code % many, -1:]])

    def dealt(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        h = np.zeros(len(self.code), np.uint64)
        for column in self.phrases.T:
            h = mix64(h) + column.astype(np.uint64)
        bucket = _bucket(h, buckets)
        return bucket, *_dealt(bucket)


_COUNTED_DDL = "unit long, bucket long, flags binary, phrases binary"
_COUNTED = pa.schema([("unit", pa.int64()), ("bucket", pa.int64()), ("flags", pa.binary()), ("phrases", pa.binary())])


def _sent(level: DataFrame, k: int, buckets: int) -> DataFrame:
    """(unit, bucket, planes): the words and counts of the distinct phrases of k + 1 words of each unit."""
    def run(batches):
        for batch in batches:
            for unit, gap, phrase, words in zip(*(batch.column(c).to_pylist() for c in range(4))):
                j = _Joined(k, gap, phrase, words)
                bucket, order, start, end = j.dealt(buckets)
                for x in range(0, len(start), 4096):
                    own = slice(x, x + 4096)
                    at = [order[a:b] for a, b in zip(start[own], end[own])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([unit] * len(at), pa.int64()), pa.array(bucket[order[start[own]]], pa.int64()),
                        pa.array([_planes([*j.phrases[i].T, j.n[i]]) for i in at], pa.binary())], names=["unit", "bucket", "planes"])

    return level.select("unit", "gap", "phrase", "words").mapInArrow(run, "unit long, bucket long, planes binary")


def _counted(sent: DataFrame, k: int, least: int) -> DataFrame:
    """For each row of ``sent`` a bit per phrase: it occurs ``least`` times in all; and
    once per bucket (unit -1) the planes of those phrases and their counts."""
    def run(rows: pa.Table) -> pa.Table:
        parts = [_columns(p, k + 2) for p in rows.column("planes").to_pylist()]
        if not parts:
            return _COUNTED.empty_table()
        size = np.cumsum([len(p) for p in parts])
        records = np.concatenate(parts)
        order = np.lexsort(records[:, k::-1].T)
        first = np.append(True, (np.diff(records[order, :k + 1], axis=0) != 0).any(axis=1))
        total = np.add.reduceat(records[order, k + 1], np.flatnonzero(first))
        often = np.zeros(len(records), bool)
        often[order] = (total >= least)[np.cumsum(first) - 1]
        units, bucket = rows.column("unit").to_pylist(), rows.column("bucket")[0].as_py()
        flags = np.split(often, size[:-1])
        out = [(u, bucket, np.packbits(f).tobytes(), None) for u, f in zip(units, flags) if f.any()]
        if out:
            kept = records[order][first][total >= least]
            out.append((-1, bucket, None, _planes([*kept[:, :k + 1].T, total[total >= least]])))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, _COUNTED)], schema=_COUNTED)

    made = sent.groupBy("bucket").applyInArrow(run, _COUNTED_DDL)
    # many tasks count, few write: bits are a small part of what they answer
    few = max(1, int(made.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    return cut_lineage(made.repartition(few))


def _phrases(counted: DataFrame, k: int) -> DataFrame:
    """(key, f) of the frequent phrases of k + 1 words."""
    def run(batches):
        for batch in batches:
            for planes in batch.column(0).to_pylist():
                sheet = _columns(planes, k + 2)
                key = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(sheet[:, :k + 1]).ravel()), k + 1)
                yield pa.RecordBatch.from_arrays([key.cast(pa.list_(pa.int64())), pa.array(np.ascontiguousarray(sheet[:, k + 1]))],
                                                 names=["key", "f"])

    return counted.where(F.col("unit") < 0).select("phrases").mapInArrow(run, "key array<long>, f long")


def _next_level(level: DataFrame, k: int, counted: DataFrame, buckets: int) -> DataFrame:
    """The occurrences of the phrases of k + 1 words that are frequent."""
    def run(unit: pa.Table, known: pa.Table) -> pa.Table:
        flags = dict(zip(known.column("bucket").to_pylist(), known.column("flags").to_pylist()))
        out = []
        for number, gap, phrase, words in zip(*(unit.column(c).to_pylist() for c in ("unit", "gap", "phrase", "words"))):
            j = _Joined(k, gap, phrase, words)
            bucket, order, start, end = j.dealt(buckets)
            often = np.zeros(len(j.code), bool)
            for x, y in zip(start.tolist(), end.tolist()):
                own = flags.get(int(bucket[order[x]]))
                if own is not None:
                    often[order[x:y]] = np.unpackbits(np.frombuffer(own, np.uint8), count=y - x).astype(bool)
            found = np.where(often, np.cumsum(often) - 1, -1)[j.which]
            at = j.at[j.left][found >= 0]
            if len(at):
                out.append(_level_row(number, at, found[found >= 0], j.phrases[often]))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, _LEVEL)], schema=_LEVEL)

    rows, answers = level.select("unit", "gap", "phrase", "words"), counted.where(F.col("unit") >= 0).select("unit", "bucket", "flags")
    return cut_lineage(rows.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(run, _LEVEL_DDL), shrink=2, options=WIDE_ROWS)


def frequent_phrases(docs: DataFrame, least: int = 30, unit_bytes: int = UNIT_BYTES,
                     bucket_words: int = BUCKET_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: (lang, n) word occurrences; (id, lang, word) of the words that
    occur ``least`` times in their language; (key, f) of all phrases of up to
    LONGEST words that do, key being their words' ids.

    A phrase is as frequent as its rarest part at most, so the levels find all.
    Phrases are counted in buckets, a bucket per ``bucket_words`` words of text,
    so no bucket sees more than about that many records at any size.
    """
    units = _units(docs, unit_bytes)
    sizes = cut_lineage(units.groupBy("lang").agg(F.sum("n_words").alias("n")), shrink=16)
    buckets = max(64, (sizes.agg(F.sum("n")).first()[0] or 0) // bucket_words)
    known = _known_words(_word_lists(units, buckets), least)
    words = known.where(F.col("ranks").isNull()).select(
        F.expr(f"shiftleft(bucket, {_RANK_BITS}) | unit").alias("id"), "lang", F.col("words")[0].alias("word"), F.col("f")[0].alias("f"))
    level = _first_level(units, known, buckets)
    found = words.select(F.array("id").alias("key"), "f")
    for k in range(1, LONGEST):
        counted = _counted(_sent(level, k, buckets), k, least)
        found = found.unionByName(_phrases(counted, k))
        if k + 1 < LONGEST:
            level = _next_level(level, k, counted, buckets)
    return sizes, words, cut_lineage(found, shrink=8)


def _exact(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def scored(phrases: DataFrame, covered_percent: int = 80) -> DataFrame:
    """(key, a, l, r, score) of the phrases of two or more words that no longer one covers.

    Every cut of a phrase into two parts scores floor(2000000 a / (l + r)), l and
    r being the parts' frequencies; the lowest counts, of equal ones the first.
    A phrase goes if a longer one that contains it has ``covered_percent`` of its
    occurrences.  All in decimals: nothing overflows or rounds.
    """
    cuts = phrases.where(F.size("key") > 1).select("key", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(key) - 1)")).alias("k"))
    cuts = cuts.select("key", "a", "k", F.expr("slice(key, 1, k)").alias("head"), F.expr("slice(key, k + 1, size(key) - k)").alias("tail"))
    cuts = cuts.join(phrases.select(F.col("key").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(phrases.select(F.col("key").alias("tail"), F.col("f").alias("r")), "tail")
    score = F.expr("(cast(a as decimal(19,0)) * cast(2000000 as decimal(7,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.groupBy("key", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inside = phrases.where(F.size("key") > 2).select("f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(key) - 1), m -> transform(sequence(1, size(key) - m + 1), s -> slice(key, s, m))))")).alias("key"))
    most = inside.groupBy("key").agg(F.max("f").alias("most"))
    kept = best.join(most, "key", "left").where(F.col("most").isNull() | (_exact(F.col("most")) * 100 < _exact(F.col("a")) * covered_percent))
    return kept.select("key", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2
    to LONGEST words, by score, frequency (both descending) and bytes.

    A-Z are folded; pieces end at ``.,;:!?`` and line ends; no phrase leaves its
    piece.  Null texts are empty, a null lang is "und"; repeated rows count each
    time; a language without a frequent phrase has no rows, nor has an empty
    table; other columns, doc_id too, are not looked at.
    """
    docs = docs.select("lang", "text")
    sizes, words, phrases = frequent_phrases(docs, least, unit_bytes)
    first = F.broadcast(sizes) if sizes.limit(10_001).count() <= 10_000 else sizes
    found = scored(phrases).withColumn("id", F.col("key")[0]).join(words.select("id", "lang"), "id").drop("id")
    order = [F.col("score").desc(), F.col("a").desc()]
    # equal scores and frequencies are decided by the text, which only the rows in question get
    near = cut_lineage(found.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place"), shrink=8)
    spelled = near.select("key", F.posexplode("key").alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("key").agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"])).alias("phrase"))
    ranked = near.join(spelled, "key").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")))
    return ranked.where(F.col("rank") <= top).join(first, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
