"""Mixing to target weights with soft domain membership: a classifier fitted on a
labelled table gives every document domain posteriors; projected gradient least
squares finds nonnegative document rates whose expected domain token totals
meet the targets.  DataFrame functions throughout."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import cut_lineage, fresh_name

#: labelled rows that the classifier is fitted on at most, taken in hash order
LABELLED_ROWS = 5000
#: word hashes of the classifier, and the words' worth of evidence that a posterior rests on at most
FEATURES, EVIDENCE = 4096, 24
ROUNDS, TOLERANCE = 30, 1e-6


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def _codes(text: Column) -> Column:
    return F.transform(_words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(FEATURES)).cast("int"))


def _numbers(values: list[float]) -> Column:
    """An array of doubles as one folded literal."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def fit_classifier(labelled: DataFrame) -> dict[str, list[float]]:
    """Smoothed log probabilities of each word hash by domain (columns text, domain).

    At most LABELLED_ROWS rows arrive here; the counts that reach the driver are
    at most FEATURES per domain.
    """
    counts = (labelled.where("domain is not null").select("domain", F.explode(_codes(F.col("text"))).alias("code"))
              .groupBy("domain", "code").agg(F.count(F.lit(1)).alias("n")).collect())
    table: dict[str, list[float]] = {}
    for r in counts:
        table.setdefault(r.domain, [0.5] * FEATURES)[r.code] += r.n
    return {k: [math.log(n / sum(table[k])) for n in table[k]] for k in sorted(table)}


def _once(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` with the columns, worked out once a row: a later filter on them is not
    rewritten into a second evaluation below."""
    name = fresh_name(docs.columns, "once")
    made = docs.withColumn(name, F.explode(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))
    return made.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"`{name}`.`{k}`").alias(k) for k in columns])


def with_posteriors(docs: DataFrame, model: dict[str, list[float]], n_tokens: str, posterior: str) -> DataFrame:
    """``docs`` with its word count and an array of domain posteriors (in the model's order).

    The mean log probability of a document's words counts as EVIDENCE words at
    most, so posteriors stay soft; a text without words has equal ones.
    """
    codes = fresh_name([*docs.columns, n_tokens, posterior], "codes")
    scores = fresh_name([*docs.columns, n_tokens, posterior], "scores")
    n = F.size(codes)
    weight = F.least(n, F.lit(EVIDENCE)) / F.greatest(n, F.lit(1))

    def total(values: list[float]) -> Column:
        table = _numbers(values)
        return F.aggregate(codes, F.lit(0.0), lambda a, i: a + F.get(table, i)) * weight

    out = _once(docs, **{codes: _codes(F.col("text"))})
    out = _once(out, **{n_tokens: n.cast("long"), scores: F.array(*[total(v) for v in model.values()])}).drop(codes)
    out = _once(out, **{scores + "_": F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))}).drop(scores)
    share = F.transform(scores + "_", lambda s: s / F.aggregate(scores + "_", F.lit(0.0), lambda a, x: a + x))
    return _once(out, **{posterior: share}).drop(scores + "_")


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """Solution of the small symmetric system (ridge against domains without tokens)."""
    n = len(b)
    ridge = 1e-9 * max(max(a[i][i] for i in range(n)), 1.0)
    m = [[*a[i], b[i]] for i in range(n)]
    for i in range(n):
        m[i][i] += ridge
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        for r in range(n):
            if r != i:
                f = m[r][i] / m[i][i]
                m[r] = [x - f * y for x, y in zip(m[r], m[i])]
    return [m[i][n] / m[i][i] for i in range(n)]


def rate_of(posterior: str, steps: list[list[float]]) -> Column:
    """A document's rate after the steps: from 1, each takes posterior . step away and stops at 0."""
    if not steps:
        return F.lit(1.0)
    k = len(steps[0])
    flat = _numbers([x for s in steps for x in s])

    def one(rate, s):
        dot = sum((F.get(F.col(posterior), F.lit(j)) * F.get(flat, s * k + j) for j in range(1, k)),
                  F.get(F.col(posterior), F.lit(0)) * F.get(flat, s * k))
        return F.greatest(F.lit(0.0), rate - dot)

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0), one)


def fit_rates(members: DataFrame, targets: list[float], n_tokens: str, posterior: str) -> list[list[float]]:
    """Projected-gradient steps for min ||sum_d rate_d n_d p_d - targets||, rate_d >= 0.

    The residual is scaled by the inverse of sum_d n_d p_d p_d' and the rates
    move in the inner product weighted by n_d, so a step of 1 is safe and equal
    posteriors get equal rates whatever the length.  Each round is one
    aggregation of as many sums as there are domains; the history of steps,
    not a rate per document, is what the driver keeps.
    """
    k = len(targets)
    p = [F.get(F.col(posterior), F.lit(j)) for j in range(k)]
    n = F.col(n_tokens)
    gram_row = members.agg(*[F.sum(n * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    gram = [[gram_row[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]
    steps: list[list[float]] = []
    for _ in range(ROUNDS):
        rate = rate_of(posterior, steps)
        row = members.select(rate.alias("_rate"), n_tokens, posterior).agg(
            *[F.sum(F.col("_rate") * n * p[j]).alias(f"t{j}") for j in range(k)]).first()
        residual = [(row[f"t{j}"] or 0.0) - targets[j] for j in range(k)]
        if max(map(abs, residual)) <= TOLERANCE * max(sum(targets), 1.0):
            break
        steps.append(_solve(gram, residual))
    return steps


def domain_targets(members: DataFrame, domains: list[str], weights: dict[str, float], n_tokens: str, posterior: str) -> list[float]:
    """Token totals to reach: domains without a weight keep their expected total,
    the others share the remaining tokens by their weights."""
    k = len(domains)
    row = members.agg(*[F.sum(F.col(n_tokens) * F.get(F.col(posterior), F.lit(j))).alias(f"t{j}") for j in range(k)]).first()
    now = [row[f"t{j}"] or 0.0 for j in range(k)]
    given = sum(weights.get(d, 0.0) for d in domains)
    rest = sum(t for d, t in zip(domains, now) if d in weights)
    return [rest * weights[d] / given if d in weights and given > 0 else t for d, t in zip(domains, now)]


def _columns(out: DataFrame, key: str, prefix: str, domains: list[str], steps: list[list[float]]) -> DataFrame:
    posterior, rate = f"{prefix}_posterior", f"{prefix}_rate"
    chance = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    names = F.split(F.lit("\u0001".join(domains)), "\u0001")
    out = _once(out, **{rate: rate_of(posterior, steps)})
    out = out.withColumn(f"{prefix}_copies", (F.floor(rate) + F.when(chance < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("int"))
    return out.withColumn(f"{prefix}_domain", F.get(names, (F.array_position(posterior, F.array_max(posterior)) - 1).cast("int"))).drop(key)


def _fitted(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], prefix: str):
    tokens, posterior, key = f"{prefix}_tokens", f"{prefix}_posterior", f"{prefix}_key"
    model = fit_classifier(labelled) or {"": [0.0] * FEATURES}
    slim = docs.select("doc_id", F.xxhash64("doc_id", "text").alias(key), "text")
    members = cut_lineage(with_posteriors(slim, model, tokens, posterior).drop("text"))
    steps = fit_rates(members, domain_targets(members, list(model), weights, tokens, posterior), tokens, posterior)
    return model, members, steps


def document_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens, domain, posterior, rate and copies of every row of ``docs``.

    ``labelled`` has columns text and domain.  copies is the rate rounded up or
    down by a hash of the row, so that it is right on average.  Without labelled
    rows every rate is 1.  Null and empty texts have no tokens and equal
    posteriors; a null domain is no label; repeated rows get equal rates and
    copies; an empty table stays empty; other columns are not looked at.
    """
    model, members, steps = _fitted(docs, labelled, weights, "mix")
    return (_columns(members, "mix_key", "mix", list(model), steps)
            .select("doc_id", F.col("mix_tokens").alias("n_tokens"), F.col("mix_domain").alias("domain"),
                    F.col("mix_posterior").alias("posterior"), F.col("mix_rate").alias("rate"), F.col("mix_copies").alias("copies")))


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, domain) of a bounded sample of labelled documents; the domain is the language."""
    some = (labels.select("doc_id").where("doc_id is not null").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS))
    return docs.join(F.broadcast(some), "doc_id").select("text", F.col("lang").alias("domain"))


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with their columns unchanged.

    Posteriors are a function of the text, so they are worked out again beside
    the rows; a join would shuffle the texts.
    """
    prefix = "mix"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    model, _, steps = _fitted(docs, labelled, weights, prefix)
    key, copies = f"{prefix}_key", f"{prefix}_copies"
    out = with_posteriors(docs.withColumn(key, F.xxhash64("doc_id", "text")), model, f"{prefix}_tokens", f"{prefix}_posterior")
    out = _columns(out, key, prefix, list(model), steps).where(F.col(copies) > 0)
    return out.withColumn(f"{prefix}_nth", F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])
