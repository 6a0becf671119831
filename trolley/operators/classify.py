"""Basket-value classification (M): labels, feature frames, split, pattern
ceiling, pattern lookup, trees / MLP via pyspark.ml, reports.

The presence pattern of a basket is its item bitmask, so the pattern
ceiling and pattern lookup are plain group-bys on (mask, label).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley import params
from trolley.functions.labels import iso_weekday
from trolley.operators.mining import MAX_ITEMS, bit, one, shl

LABELS = params.SEGMENT_LABELS  # order also breaks ties (Small, Medium, Large)


def label_index():
    return F.create_map(*[x for i, lab in enumerate(LABELS) for x in (F.lit(lab), F.lit(i))])


def basket_labels(dim_basket: DataFrame) -> DataFrame:
    d = dim_basket.groupBy(F.col("basket_segment").alias("label")).agg(F.count(F.lit(1)).alias("baskets"))
    return d.select("label", "baskets",
                    F.round(F.col("baskets") / F.sum("baskets").over(Window.partitionBy()), 6).alias("share"),
                    (F.col("baskets") == F.max("baskets").over(Window.partitionBy())).alias("is_majority"))


def flag_cols(n_items: int, prefix: str = "f_"):
    return [((F.col("mask").bitwiseAND(shl(one(), F.lit(i)))) != 0).cast("int").alias(f"{prefix}{i:02d}")
            for i in range(n_items)]


def features_binary(masks: DataFrame, n_items: int) -> DataFrame:
    """presence flags per item (bounded domain)."""
    return masks.select("basket_id", *flag_cols(n_items))


def calendar_months(lines: DataFrame) -> list:
    """The calendar months (YYYY-MM) of the data in order: one per month of its span."""
    return [r["m"] for r in lines.select(F.date_format("sale_date", "yyyy-MM").alias("m")).distinct().orderBy("m").collect()]


def basket_extras(lines: DataFrame) -> DataFrame:
    """Per basket: distinct products, distinct categories, first date.

    Both counts are distributed: (basket, product) pairs are made distinct
    before they are counted, so no basket is gathered into one buffer.
    """
    prod = (lines.groupBy("basket_id", "product_id").agg(F.min("sale_date").alias("d"))
            .groupBy("basket_id").agg(F.count(F.lit(1)).alias("n_items"), F.min("d").alias("d")))
    cat = lines.select("basket_id", "category").distinct().groupBy("basket_id").agg(F.count(F.lit(1)).alias("n_categories"))
    return prod.join(cat, "basket_id")


def extra_cols(months: list) -> list:
    wd = [(iso_weekday("d") == k).cast("int").alias(f"wd_{k}") for k in range(1, 8)]
    mo = [(F.date_format("d", "yyyy-MM") == m).cast("int").alias(f"mo_{m.replace('-', '_')}") for m in months]
    return ["n_items", "n_categories", *wd, *mo]


def features_discrete(masks: DataFrame, extras: DataFrame, n_items: int, months: list) -> DataFrame:
    """F0 + distinct products, distinct categories, weekday and calendar-month flags."""
    return masks.join(extras, "basket_id").select("basket_id", *flag_cols(n_items), *extra_cols(months))


def features_full(lines: DataFrame, index: DataFrame, extras: DataFrame, months: list) -> DataFrame:
    """quantity per item (pivot over the bounded, explicit domain) + the extras of F1."""
    items = [r["item"] for r in index.orderBy("idx").collect()]
    p = (lines.join(F.broadcast(index.withColumnRenamed("item", "category")), "category")
         .groupBy("basket_id").pivot("idx", list(range(len(items)))).agg(F.sum("quantity")))
    q = [F.round(F.coalesce(F.col(str(i)), F.lit(0.0)), 4).alias(f"q_{i:02d}") for i in range(len(items))]
    return p.join(extras, "basket_id").select("basket_id", *q, *extra_cols(months))


def patterns(features: DataFrame, labelled: DataFrame) -> DataFrame:
    """The labelled baskets with the exact feature row as their pattern.

    The row is written as its values other than 0, each with its column's place
    (most are flags that are 0): no two rows have the same text.
    """
    cells = [F.when(F.col(c).isNull(), F.lit(f"{i}=")).when(F.col(c) != 0, F.concat(F.lit(f"{i}="), F.col(c).cast("string")))
             for i, c in enumerate(c for c in features.columns if c != "basket_id")]
    return labelled.drop("pattern").join(features.select("basket_id", F.concat_ws("|", *cells).alias("pattern")), "basket_id")


def split_hash(key) -> F.Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit("42"))), 1, 8), 16, 10).cast("bigint")


def stratified_split(labelled: DataFrame) -> DataFrame:
    """Exactly 70 % of every label (rounded half up) is training, by hash order.

    The rank is distributed: hashes are counted in 65,536 ranges per label; the
    range in which a label's quota ends is ranked row by row, all others fall
    on one side as a whole.
    """
    h = labelled.withColumn("_h", split_hash(F.col("basket_id"))).withColumn("_b", F.call_function("shiftright", F.col("_h"), F.lit(16)))
    n = h.groupBy("label", "_b").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("label").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    n = (n.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
         .withColumn("quota", F.floor((F.sum("n").over(Window.partitionBy("label")) * 7 + 5) / 10)))
    edge = n.filter((F.col("before") < F.col("quota")) & (F.col("before") + F.col("n") >= F.col("quota")))
    edge = edge.select("label", F.col("_b").alias("_edge"), (F.col("quota") - F.col("before")).alias("_need"))  # a row per label
    j = h.join(F.broadcast(edge), "label", "left")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("_h", "basket_id"))
    within = j.filter(F.col("_b") == F.col("_edge")).withColumn("is_train", rank <= F.col("_need"))
    others = (j.filter(F.col("_edge").isNull() | (F.col("_b") != F.col("_edge")))
              .withColumn("is_train", F.coalesce(F.col("_b") < F.col("_edge"), F.lit(False))))
    return others.unionByName(within).drop("_h", "_b", "_edge", "_need")


def feature_ceiling(patterns: DataFrame) -> DataFrame:
    """(pattern, label) -> best achievable accuracy of any function of the pattern."""
    pl = patterns.groupBy("pattern", "label").agg(F.count(F.lit(1)).alias("n"))
    pp = pl.groupBy("pattern").agg(F.max("n").alias("best"), F.sum("n").alias("tot"))
    return pp.agg(F.sum("tot").alias("baskets"), F.count(F.lit(1)).alias("patterns"),
                  F.count_if(F.col("tot") == 1).alias("singleton_patterns"),
                  F.round(F.count_if(F.col("tot") == 1) / F.sum("tot"), 6).alias("singleton_basket_share"),
                  F.round(F.sum("best") / F.sum("tot"), 6).alias("ceiling"))


def pattern_lookup(train: DataFrame, test: DataFrame) -> DataFrame:
    """Predict each test basket with the training majority of its exact
    pattern (ties by label order), else the overall training majority."""
    li = label_index()
    pl = train.groupBy("pattern", "label").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("pattern").orderBy(F.desc("n"), li[F.col("label")])
    maj = pl.withColumn("rk", F.row_number().over(w)).filter("rk = 1").select("pattern", F.col("label").alias("pm"))
    overall = (train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), li[F.col("label")]).limit(1).select("label"))
    fallback = overall.agg(F.first("label")).scalar()
    j = test.join(maj, "pattern", "left")
    return j.select("basket_id", "label", F.coalesce("pm", fallback).alias("prediction"),
                    F.col("pm").isNull().alias("unseen"))


def lookup_summary(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("tested"),
                    F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 6).alias("accuracy"),
                    F.round(F.avg(F.col("unseen").cast("double")), 6).alias("unseen_share"))


def classifier_report(pred: DataFrame) -> DataFrame:
    """Precision / recall / F1 per class from (label, prediction)."""
    c = pred.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    tp = c.filter(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    actual = c.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("actual"))
    predicted = c.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    j = actual.join(predicted, "cls", "full_outer").join(tp, "cls", "left").fillna(0, ["tp", "actual", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0)
    return j.select("cls", F.col("tp").cast("bigint"), F.col("actual").cast("bigint"),
                    F.col("predicted").cast("bigint"), F.round(p, 6).alias("precision"),
                    F.round(r, 6).alias("recall"),
                    F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1"))


def recall_comparison(preds: dict) -> DataFrame:
    """Recall per class of several models' predictions (name -> label, prediction) and
    each one's gain over the first."""
    first, *others = preds
    out = None
    for name, pred in preds.items():
        r = pred.groupBy(F.col("label").alias("cls")).agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias(name))
        out = r if out is None else out.join(r, "cls")  # a row per class
    return out.select("cls", *[F.round(n, 6).alias(f"recall_{n}") for n in preds],
                      *[(F.round(F.col(n) - F.col(first), 6) + F.lit(0.0)).alias(f"delta_{n}") for n in others])


def ceiling_share(pred: DataFrame, patterns: DataFrame) -> DataFrame:
    """Accuracy beside the best that the features allow, and the share of it."""
    # raw ratios: a share of rounded figures would be off in the last digits
    a = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("a"))
    best = (patterns.groupBy("pattern", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("pattern")
            .agg(F.max("n").alias("best"), F.sum("n").alias("tot")).agg((F.sum("best") / F.sum("tot")).alias("c")))
    return a.join(F.broadcast(best), F.lit(True)).select(  # one row each
        F.round("a", 6).alias("accuracy"), F.round("c", 6).alias("ceiling"), F.round(F.col("a") / F.col("c"), 6).alias("share_of_ceiling"))


# ---------------------------------------------------------- pyspark.ml ----
def _assemble(df: DataFrame, feats: list):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    lab = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc")
    vec = VectorAssembler(inputCols=feats, outputCol="features")
    return lab, vec


def weighted(train: DataFrame, feats: list) -> DataFrame:
    """The training rows with a weight ``w``.  Baskets of the same flags and label become one row
    weighted by their number, which leaves every split's counts as they are; wider
    feature rows hardly repeat and stay rows of their own."""
    if len(feats) > MAX_ITEMS:
        return train.withColumn("w", F.lit(1.0))
    return train.groupBy("label", *feats).agg(F.count(F.lit(1)).cast("double").alias("w"))


def fitted_tree(train: DataFrame, feats: list, depth: int, seed: int = 42):
    """Fitted pipeline: label index, feature vector, tree."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    lab, vec = _assemble(train, feats)
    dt = DecisionTreeClassifier(labelCol="y", featuresCol="features", weightCol="w", maxDepth=min(depth, 30), seed=seed,
                                impurity="gini")
    return Pipeline(stages=[lab, vec, dt]).fit(train if "w" in train.columns else weighted(train, feats))


def _mask(flags: list):
    """The flags' bits, the first lowest; only 0 and 1 are flags."""
    out = F.lit(0).cast("bigint")
    for i, c in enumerate(flags):
        out = out.bitwiseOR(F.when(F.col(c) == 1, bit(F.lit(i))).when(F.col(c) == 0, F.lit(0).cast("bigint"))
                            .otherwise(F.raise_error(F.lit(f"{c} is no flag")).cast("bigint")))
    return out.alias("mask")


def tree_paths(train: DataFrame, test: DataFrame, feats: list, depth: int) -> DataFrame:
    """Test baskets with their class ``y`` and ``path``, the class that a tree of presence flags predicts at
    each of its depths up to ``depth``, a character each.  A tree cut at a depth is the tree grown to it."""
    from trolley.operators import flagtree
    from trolley.session import written
    lab = _assemble(train, feats)[0].fit(train)
    train = train if "w" in train.columns else weighted(train, feats)
    counts = [F.sum(F.when(F.col("label") == x, F.col("w")).otherwise(0.0)).alias(f"c{k}") for k, x in enumerate(lab.labels)]
    test = lab.transform(test.select("basket_id", "label", _mask(feats))).withColumn("y", F.col("y").cast("int"))
    rows = train.select(_mask(feats), "label", "w", F.lit(False).alias("asked")).unionByName(
        test.select("mask", "label", F.lit(0.0).alias("w"), F.lit(True).alias("asked")))
    rows = written(rows.groupBy("mask").agg(*counts, F.max("asked").alias("asked")))  # read once a level
    return test.join(flagtree.paths(rows, len(feats), len(lab.labels), depth), "mask").select("basket_id", "label", "y", "path")


def decision_tree(train: DataFrame, test: DataFrame, feats: list, depth: int = 5, deeper: DataFrame = None) -> DataFrame:
    """Predictions of a tree of presence flags; ``deeper``: the paths of one that is at least as deep."""
    grown = tree_paths(train, test, feats, depth) if deeper is None else deeper
    return grown.select("basket_id", "label", "y", (F.ascii(F.substring("path", depth + 1, 1)) - ord("0")).cast("int").alias("p"))


def mlp(train: DataFrame, test: DataFrame, feats: list, hidden=(64, 32), max_iter: int = 50,
        seed: int = 42) -> DataFrame:
    """Network over log1p'd, standardised features; baskets of the same flags and label train as one weighted row."""
    from trolley.operators import network
    from trolley.session import written
    sizes = [len(feats), *hidden, len(LABELS)]
    lab = _assemble(train, feats)[0].fit(train)
    rows = lab.transform(weighted(train.select("label", *feats), feats))
    # read by every evaluation: dealt evenly, as each one takes as long as its fullest task
    packed = written(network.blocks(rows, feats).repartition(4 * train.sparkSession.sparkContext.defaultParallelism))
    model = network.fit(packed, sizes, max_iter, seed)
    test = lab.transform(test).withColumn("y", F.col("y").cast("int"))
    return network.predict(test, feats, ["basket_id", "label", "y"], model, sizes)


def accuracy(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("tested"),
                    F.round(F.avg((F.col("y") == F.col("p")).cast("double")), 6).alias("accuracy"))


def tree_report(train: DataFrame, test: DataFrame, feats: list, depth: int = 5, seed: int = 42):
    """Fitted tree's rule text (feature names put in), leaves and importances, and its test predictions."""
    model = fitted_tree(train, feats, depth, seed)
    tree = model.stages[-1]
    import re
    rules = re.sub(r"feature (\d+)", lambda m: feats[int(m[1])], tree.toDebugString)
    leaves = (tree.numNodes + 1) // 2  # a binary tree
    return rules, leaves, dict(zip(feats, tree.featureImportances.toArray().tolist())), model.transform(test).select(
        "basket_id", "label", F.col("y").cast("int").alias("y"), F.col("prediction").cast("int").alias("p"))
