"""Quality rules: base counts of a text, and the Jensen-Shannon distance of its
character-class and common-word histograms from its language's references."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import (
    append_struct,
    bytes_and_offsets,
    covered,
    cut_lineage,
    fresh_name,
    mix64,
    row_slices,
    text_column,
    window_hashes,
    word_hashes,
    words_of,
)

#: fixed by the contract of the base counts
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5

#: a word is common in a language if it makes up this share of its words
COMMON_SHARE = 0.002
#: a text of n characters (words) is rejected beyond base + slack / sqrt(n): sampling noise moves
#: short texts away from any reference; below the guards the distance is not judged at all
CHAR_LIMIT, WORD_LIMIT = (0.17, 2.6), (0.30, 1.6)
CHAR_GUARD, WORD_GUARD = 200, 30
#: a language gets references of its own from this share of all documents (so there are at most 1000)
LANGUAGE_SHARE = 0.001
POOLED = "*"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
#: byte classes: 0 lower, 1 upper, 2 digit, 3 white space, 4 sentence marks, 5 other ASCII,
#: 6 first byte of any other character, 7 its further bytes (not counted)
_CLASSES = 7
_CLASS = np.full(256, 5, np.int64)
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[0xC0:] = 6
_CLASS[0x80:0xC0] = 7


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _repeats(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: the (row, key) occurs more than once; it has occurred before."""
    both = key ^ mix64(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    twice, again = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, again


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The contract's counts for each row, and the words found on the way."""
    n = len(off) - 1
    start, end, row = words_of(data, off)
    code = word_hashes(data, start, end)
    at, win = window_hashes(code, row, REPEAT_WINDOW)
    twice, _ = _repeats(row[at], win)
    in_repeat = covered(len(start), at[twice], REPEAT_WINDOW)

    breaks = np.flatnonzero(data == 10)
    line_from = np.union1d(off[:-1], breaks + 1)
    line_from = line_from[line_from < len(data)]
    line_to = np.minimum(np.append(line_from[1:], len(data)), len(data))
    line_to = np.where((line_to > line_from) & (data[np.maximum(line_to - 1, 0)] == 10), line_to - 1, line_to) if len(data) else line_to
    worded = np.searchsorted(start, line_from) < np.searchsorted(start, line_to)
    line_from, line_to = line_from[worded], line_to[worded]
    line_row = np.searchsorted(off, line_from, "right") - 1
    _, again = _repeats(line_row, word_hashes(data, line_from, line_to))

    n_words = np.bincount(row, minlength=n)
    n_repeat = np.bincount(row[in_repeat], minlength=n)
    cls = _CLASS[data]
    return {
        "n_words": n_words, "word_chars": _per_row((cls != 7) & (cls != 3), off),
        "n_symbols": _per_row(_IS_SYMBOL[data], off), "n_dup_lines": np.bincount(line_row[again], minlength=n),
        "n_repeat_words": n_repeat, "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_PERCENT * n_words),
        "class": cls, "code": code, "row": row,
    }


def _char_histogram(cls: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    use = cls < _CLASSES
    return np.bincount(row[use] * _CLASSES + cls[use], minlength=n * _CLASSES).reshape(n, _CLASSES)


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence (base 2) of each row of counts
    from the reference; a row without counts is at distance 0."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    q = np.broadcast_to(reference / max(reference.sum(), 1), p.shape)
    mid = (p + q) / 2

    def part(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(np.where(x > 0, x / mid, 1.0)), 0.0).sum(axis=1)

    d = np.sqrt(np.maximum((part(p) + part(q)) / 2, 0.0))
    return np.where(total[:, 0] > 0, d, 0.0)


def _languages(part: pa.RecordBatch, known: set[str] | None = None) -> list[str]:
    names = ["" if v is None else v for v in part.column(part.schema.get_field_index("lang")).to_pylist()]
    return names if known is None else [v if v in known else POOLED for v in names]


def _distinct_texts(docs: DataFrame) -> DataFrame:
    """(lang, text): each text once in its language, so that copies weigh nothing."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    return rows.dropDuplicates(["lang", "h1", "h2"]).select("lang", "text")


#: different words that a task adds up before it passes the sums on
_HELD = 1 << 20


def _local_counts(docs: DataFrame, known: list[str], frequent: bool = False) -> DataFrame:
    """(lang, kind, code, n) of each task: kind 'c' character classes, 't' words in all, 'w' each word,
    or with ``frequent`` those that reach half the common share of the words added up together."""
    schema = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("code", pa.int64()), ("n", pa.int64())])
    langs = [*known, POOLED]

    def run(batches):
        total = dict.fromkeys(langs, 0)
        chars = {v: np.zeros(_CLASSES, np.int64) for v in langs}
        pending: dict[str, list[np.ndarray]] = {v: [] for v in langs}

        def rows(v, kind, code, n):
            return pa.RecordBatch.from_arrays([pa.array([v] * len(code)), pa.array([kind] * len(code)), pa.array(code, pa.int64()),
                                               pa.array(n, pa.int64())], schema=schema)

        def flush(v):
            u, n = np.unique(np.concatenate(pending[v]), return_counts=True)
            pending[v] = []
            if frequent:
                most = n >= COMMON_SHARE / 2 * n.sum()
                u, n = u[most], n[most]
            return rows(v, "w", u.view(np.int64), n)

        for batch in batches:
            for part in row_slices(batch, "text"):
                data, off = bytes_and_offsets(text_column(part, "text"))
                start, end, row = words_of(data, off)
                code = word_hashes(data, start, end)
                lang = np.array([langs.index(v) for v in _languages(part, set(known))])
                hist = _char_histogram(_CLASS[data], off)
                for k, v in enumerate(langs):
                    mine = lang == k
                    if v == POOLED:
                        mine = np.ones(len(lang), bool)
                    if not mine.any():
                        continue
                    chars[v] += hist[mine].sum(axis=0)
                    own = code[mine[row]]
                    total[v] += len(own)
                    pending[v].append(own)
                    if sum(map(len, pending[v])) > _HELD:
                        yield flush(v)
        for v in langs:
            if pending[v]:
                yield flush(v)
            yield rows(v, "t", [0], [total[v]])
            yield rows(v, "c", list(range(_CLASSES)), chars[v].tolist())

    return docs.mapInArrow(run, "lang string, kind string, code long, n long")


def references(docs: DataFrame) -> dict[str, dict]:
    """Per language: character-class counts, common words (by hash) and their counts
    over all distinct texts, and the number of words.

    A text that occurs often counts once in its language: a group of copies,
    however large, can't colour the references.  Size bound: at most
    1 / LANGUAGE_SHARE languages of 1 / COMMON_SHARE common words.  A word that
    reaches the common share overall reaches half of it summed over the pieces
    in which it reaches half; these candidates, at most twice as many, are
    broadcast, and only their counts are shuffled.  Both looks at the texts
    read one exchange.
    """
    by_lang = docs.groupBy(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    by_lang = cut_lineage(by_lang, shrink=16)
    total = by_lang.agg(F.sum("n")).first()[0] or 0
    known = sorted(r.lang for r in by_lang.where((F.col("n") >= LANGUAGE_SHARE * total) & (F.col("lang") != POOLED)).collect())
    texts, key = _distinct_texts(docs), ["lang", "kind", "code"]
    first = _local_counts(texts, known, frequent=True).groupBy(*key).agg(F.sum("n").alias("n"))
    size = first.where("kind = 't'").select("lang", F.col("n").alias("size"))  # a row per language
    wanted = first.join(F.broadcast(size), "lang").where((F.col("kind") != "w") | (F.col("n") >= COMMON_SHARE / 2 * F.col("size"))).select(*key)
    exact = _local_counts(texts, known).join(F.broadcast(wanted), key, "left_semi")
    counts = cut_lineage(exact.groupBy(*key).agg(F.sum("n").alias("n")), shrink=8)
    out = {v: {"chars": np.zeros(_CLASSES, np.int64), "size": 0, "code": np.zeros(0, np.uint64), "n": np.zeros(0, np.int64)}
           for v in [*known, POOLED]}
    for r in counts.where("kind <> 'w'").collect():
        if r.kind == "c":
            out[r.lang]["chars"][r.code] = r.n
        else:
            out[r.lang]["size"] = r.n
    sizes = counts.where("kind = 't'").select("lang", F.col("n").alias("size"))  # a row per language
    common = counts.where("kind = 'w'").join(F.broadcast(sizes), "lang").where(F.col("n") >= COMMON_SHARE * F.col("size")).collect()
    for v, ref in out.items():
        mine = sorted((np.array([r.code], np.int64).view(np.uint64)[0], r.n) for r in common if r.lang == v)
        ref["code"] = np.array([c for c, _ in mine], np.uint64)
        ref["n"] = np.array([n for _, n in mine], np.int64)
    return out


_DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, char_js double, word_js double")
_SCHEMA = pa.schema([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                     ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                     ("kept", pa.bool_()), ("char_js", pa.float64()), ("word_js", pa.float64())])


def with_verdicts(docs: DataFrame, name: str, char_limit: tuple[float, float] = CHAR_LIMIT,
                  word_limit: tuple[float, float] = WORD_LIMIT) -> DataFrame:
    """``docs`` with a struct column ``name``: the base counts, both distances and ``kept``.

    A text that fails the base rules is not kept.  Beyond them the distances
    decide, each only for texts of at least its guard (characters, words).
    Null and empty texts have zero counts and fail the base rules; a language
    that is null or rare is held against the pooled references; repeated rows
    and null doc_ids are rows like others; an empty table stays empty; further
    columns are passed through whatever their names.
    """
    refs = references(docs)
    known = set(refs) - {POOLED}

    def compute(part):
        data, off = bytes_and_offsets(text_column(part, "text"))
        out = base_counts(data, off)
        n = len(off) - 1
        hist = _char_histogram(out.pop("class"), off)
        code, row = out.pop("code"), out.pop("row")
        out["char_js"], out["word_js"] = np.zeros(n), np.zeros(n)
        lang = np.array(_languages(part, known), object)
        for v in set(lang.tolist()):
            ref, mine = refs[v], np.flatnonzero(lang == v)
            out["char_js"][mine] = js_distance(hist[mine], ref["chars"])
            w = len(ref["code"])
            local = np.full(n, -1)
            local[mine] = np.arange(len(mine))
            own = local[row] >= 0
            at = np.minimum(np.searchsorted(ref["code"], code[own]), max(w - 1, 0))
            bins = np.where(ref["code"][at] == code[own], at, w) if w else np.zeros(int(own.sum()), np.int64)
            counts = np.bincount(local[row][own] * (w + 1) + bins, minlength=len(mine) * (w + 1)).reshape(len(mine), w + 1)
            out["word_js"][mine] = js_distance(counts, np.append(ref["n"], ref["size"] - ref["n"].sum()))
        bad = np.zeros(n, bool)
        for d, size, (base, slack), guard in ((out["char_js"], hist.sum(axis=1), char_limit, CHAR_GUARD),
                                              (out["word_js"], out["n_words"], word_limit, WORD_GUARD)):
            bad |= (size >= guard) & (d > base + slack / np.sqrt(np.maximum(size, 1)))
        out["kept"] = ~out["base_failed"] & ~bad
        return out

    return append_struct(docs, name, _DDL, _SCHEMA, compute)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the two distances, for every row."""
    name = fresh_name(docs.columns, "rules")
    counts = [f"{name}.{f.name}" for f in _SCHEMA if not f.name.endswith("_js")]
    return with_verdicts(docs.select("doc_id", "text", "lang"), name).select(
        "doc_id", *counts, *[F.round(f"{name}.{c}", 6).alias(c) for c in ("char_js", "word_js")])


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns unchanged."""
    name = fresh_name(docs.columns, "rules")
    return with_verdicts(docs, name).where(F.col(f"{name}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
