"""Benchmark decontamination by template windows: numbers, names and units
become typed placeholders, windows of the templates are joined by hash, and the
names in the slots must map one to one.  DataFrame functions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import cut_lineage, fresh_name

WIDTH = 8
#: words of a benchmark window that must be no placeholders
MIN_LITERALS = 4
#: a document is contaminated if it covers this share of an item, or so many of its words
MIN_SHARE, MIN_RUN = 0.5, 20
#: up to so many benchmark windows (24 bytes each, up to three for each place) are sent to every executor; more are joined by shuffle
BROADCAST_WINDOWS = 500_000
#: units of measure that count as such directly after a number (fixed values)
UNITS = ("mm cm dm m km in ft yd mi mile miles metre metres meter meters mg g kg lb lbs oz ton tons ml cl l litre litres "
         "liter liters s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month "
         "months year years mph kmh percent dollar dollars euro euros cent cents pound pounds degree degrees").split()

#: capitalised sentence starts that are no names, and words that are numbers (fixed values)
FUNCTION_WORDS = ("a about after again all also although an and another any are as at because before both but by can could did do does "
                  "during each either even every few find finally first for from give given had has have he her here his how however i if "
                  "in instead into is it its last later let many may more most much my neither no not now of on once only or other our out "
                  "over own she should since so some sometimes still such suppose than that the their them then there these they this "
                  "those though through thus to today together under until up was we were what when where whether which while who whose "
                  "why will with without would yesterday yet you your").split()
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
                "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen").split()

_START, _NAME, _NUMBER, _UNIT, _AFTER = "\u0001", "\u0002", "\u0003", "\u0004", "\u0005"


def template_tokens(text: Column) -> Column:
    """Lower-cased words without punctuation; names, numbers and units after
    numbers carry their placeholder's mark in front of their value, capitals
    that begin a sentence the mark of a start.

    A name is a capitalised word that begins no sentence.  The runs of marks and
    white space that a pattern looks through are bounded, so long runs take linear time.
    """
    t = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "\u0001\u0002\u0003\u0004", "    "),
                         r"(^|[.!?:][^\p{L}\p{N}\s]{0,3}\s{1,16}|[\r\n]\s{0,16})(?=\p{Lu})", f"$1{_START}")
    t = F.regexp_replace(t, r"(\s[\"'(\[]*)(?=\p{Lu}\p{Ll})", f"$1{_NAME}")
    joined = F.regexp_replace(t, r"(?<=\p{N})[.,:/](?=\p{N})", "")
    number = F.regexp_replace(joined, r"(^|[^\p{L}\p{N}])(?=\p{N})", f"$1{_NUMBER}")
    unit = F.regexp_replace(number, rf"(?i)({_NUMBER}\p{{N}}+)\s*(?=(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}]))", f"$1 {_UNIT}")
    t = F.when(t.rlike(r"\p{N}"), unit).otherwise(t)
    t = F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}\u0001-\u0004]+", " ")
    return F.split(F.trim(t), " ")


def _value(w: Column) -> Column:
    """The token without its mark."""
    return F.when(w < _AFTER, F.substring(w, 2, 1 << 30)).otherwise(w)


def _wide(w: Column) -> Column:
    """The placeholder's mark in the wide template, or an empty string: sentence starts that
    are no function words are names too, and number words are numbers."""
    bare = _value(w)
    return (F.when((w >= _NAME) & (w < _AFTER), F.substring(w, 1, 1)).when(bare.isin(NUMBER_WORDS), _NUMBER)
            .when((w < _NAME) & (w != "") & ~bare.isin(FUNCTION_WORDS), _NAME).otherwise(""))


def _narrow(w: Column) -> Column:
    """The placeholder's mark in the narrow template: sentence starts and number words are literal."""
    return F.when((w >= _NAME) & (w < _AFTER), F.substring(w, 1, 1)).otherwise("")


def _untitled(w: Column) -> Column:
    """The placeholder's mark where names are literal, as in copies without or all in capitals."""
    return F.when((w >= _NUMBER) & (w < _AFTER), F.substring(w, 1, 1)).otherwise("")


def _template_hashes(tokens: Column, kind) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(F.when(kind(w) != "", kind(w)).otherwise(_value(w))))


def _narrow_hashes(tokens: Column) -> Column:
    """``_template_hashes(tokens, _narrow)``, each token looked at once."""
    return F.transform(tokens, lambda w: F.when(w >= _AFTER, F.xxhash64(w)).when(w >= _NAME, F.xxhash64(F.substring(w, 1, 1)))
                       .otherwise(F.xxhash64(F.substring(w, 2, 1 << 30))))


def _wide_hashes(tokens: Column, narrow: Column) -> Column:
    """``_template_hashes(tokens, _wide)`` from the narrow ones, which most tokens share."""
    def start(w, code):
        bare = F.substring(w, 2, 1 << 30)
        return (F.when(bare.isin(NUMBER_WORDS), F.xxhash64(F.lit(_NUMBER)))
                .when((w != "") & ~bare.isin(FUNCTION_WORDS), F.xxhash64(F.lit(_NAME))).otherwise(code))

    return F.zip_with(tokens, narrow, lambda w, code: F.when(w.isin(NUMBER_WORDS), F.xxhash64(F.lit(_NUMBER)))
                      .when(w >= _NAME, code).otherwise(start(w, code)))


def _windows(codes: Column) -> Column:
    n = F.size(codes)
    return F.when(n >= WIDTH, F.transform(F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0))),
                                          lambda i: F.xxhash64(F.slice(codes, i + 1, WIDTH))))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: doc_id, item_id,
    row_key (hash of doc_id and text), covered (words of the item found),
    item_words, share, n_slots, reworded (some slot has another value).

    A window matches by either of two templates: the narrow one takes sentence
    starts and number words literally, the wide one takes them for names (unless
    they are FUNCTION_WORDS) and numbers.  Items have a third one with literal
    names, for copies without capitals or all in capitals.

    Slots: the windows of an alignment are judged by runs without a gap.  Numbers
    and units may take any value.  Within a run a name of the item should stand
    for one name of the document and the reverse: where it does not, the pair
    that is most frequent for both its names holds, and any other pair of
    different names (of equally frequent ones each) is odd.  A window with an
    odd pair doesn't count; if a run has more odd than other name slots, only
    its windows with the item's own values do.  Null or empty texts, and texts or items of fewer than WIDTH words, match nothing;
    repeated rows of documents give one row, repeated items one each by item_id (a null item_id is an id like others);
    an empty table on either side gives no rows; other columns are not looked at.
    """
    items = cut_lineage(benchmark.select(F.struct("item_id").alias("item_id"), template_tokens(F.col("text")).alias("words"))
                        .where(F.size("words") >= WIDTH).distinct(), shrink=16)
    forms = []
    for kind in (_narrow, _wide, _untitled):
        form = items.select("item_id", "words", F.posexplode(_windows(_template_hashes(F.col("words"), kind))).alias("b_pos", "h"))
        literal = F.size(F.filter(F.slice("words", F.col("b_pos") + 1, F.lit(WIDTH)), lambda w: kind(w) == ""))
        forms.append(form.where(literal >= MIN_LITERALS).select("h", "item_id", "b_pos"))
    bench = cut_lineage(forms[0].unionByName(forms[1]).unionByName(forms[2]).distinct(), shrink=16)

    key = F.xxhash64("doc_id", "text")
    codes = docs.select("doc_id", key.alias("row_key"), template_tokens(F.col("text")).alias("words"))
    codes = codes.select("doc_id", "row_key", "words", _narrow_hashes(F.col("words")).alias("narrow"))
    codes = codes.select("doc_id", "row_key", "narrow", _wide_hashes(F.col("words"), F.col("narrow")).alias("wide"))
    codes = codes.select("doc_id", "row_key", _windows(F.col("narrow")).alias("narrow"), _windows(F.col("wide")).alias("wide"))
    # the wide window only where it is another one
    places = F.zip_with("narrow", "wide", lambda a, b: F.when(a == b, F.array(a)).otherwise(F.array(a, b)))
    windows = (codes.select("doc_id", "row_key", F.posexplode(places).alias("pos", "hs"))
               .select("doc_id", "row_key", "pos", F.explode("hs").alias("h")))
    if bench.count() <= BROADCAST_WINDOWS:
        found = windows.join(F.broadcast(bench), "h")
    else:  # a window may stand in a third of all documents: spread each over salts
        salts = 32
        found = (windows.withColumn("salt", F.pmod("row_key", F.lit(salts)))
                 .join(bench.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), ["h", "salt"]))
    hits = found.select("doc_id", "row_key", "item_id", "b_pos", (F.col("pos") - F.col("b_pos")).alias("shift")).distinct()
    along = Window.partitionBy("doc_id", "row_key", "item_id", "shift").orderBy("b_pos")
    hits = hits.withColumn("gap", F.col("b_pos") - F.lag("b_pos").over(along))
    hits = cut_lineage(hits.withColumn("run", F.sum(F.when(F.col("gap") <= WIDTH, 0).otherwise(1)).over(along)).drop("gap"), shrink=8)

    run = ["row_key", "item_id", "shift", "run"]
    runs = hits.groupBy(*run).agg(F.min("b_pos").alias("lo"), F.max("b_pos").alias("hi"))
    slotted = items.where(F.exists("words", lambda w: _wide(w) != ""))
    todo = cut_lineage(runs.join(slotted, "item_id"), shrink=8)
    wanted = todo.select("row_key").distinct()
    texts = (docs.select(key.alias("row_key"), "text").join(wanted, "row_key").dropDuplicates(["row_key"])
             .select("row_key", template_tokens(F.col("text")).alias("doc_words")))
    aligned = F.transform(F.sequence("lo", F.col("hi") + WIDTH - 1), lambda i: F.struct(
        i.alias("pos"), F.get("words", i).alias("b"), F.get("doc_words", (i + F.col("shift")).cast("int")).alias("d")))
    slots = F.filter(aligned, lambda p: (_wide(p["b"]) != "") & (_wide(p["b"]) == _wide(p["d"])))
    pairs = (todo.join(texts, "row_key").select(*run, F.explode(slots).alias("s"))
             .groupBy(*run, _wide(F.col("s.b")).alias("kind"), _value(F.col("s.b")).alias("b"), _value(F.col("s.d")).alias("d"))
             .agg(F.collect_list("s.pos").alias("at")).withColumn("n", F.size("at")))

    def leads(side: str) -> Column:
        """The pair is the most frequent one of its value on this side, without a tie."""
        by = Window.partitionBy(*run, "kind", side).orderBy(F.desc("n"))
        return (F.row_number().over(by) == 1) & (F.coalesce(F.lead("n").over(by), F.lit(0)) < F.col("n"))

    named = F.col("kind") == _NAME
    pairs = pairs.withColumn("odd", named & (F.col("b") != F.col("d")) & ~(leads("b") & leads("d")))
    whole = Window.partitionBy(*run)
    pairs = cut_lineage(pairs.withColumn("trusted", F.sum(F.when(named, F.when(F.col("odd"), -F.col("n")).otherwise(F.col("n"))).otherwise(0)).over(whole) >= 0)
                        .withColumn("n_slots", F.sum("n").over(whole)), shrink=8)
    counts = pairs.groupBy(*run).agg(F.max("n_slots").alias("n_slots"))
    touched = (pairs.where("b <> d").select(*run, (F.col("odd") | ~F.col("trusted")).alias("odd"), F.explode("at").alias("pos"))
               .select(*run, "odd", F.explode(F.sequence(F.col("pos") - WIDTH + 1, F.col("pos"))).alias("b_pos"))
               .groupBy(*run, "b_pos").agg(F.max("odd").alias("odd")))
    judged = (hits.join(touched, [*run, "b_pos"], "left").where(~F.coalesce("odd", F.lit(False)))
              .join(counts, run, "left").withColumn("reworded", F.col("odd").isNotNull()))

    places = judged.groupBy("doc_id", "row_key", "item_id", "b_pos").agg(
        F.max(F.coalesce("n_slots", F.lit(0))).alias("n_slots"), F.min("reworded").alias("reworded"))
    following = F.lead("b_pos").over(Window.partitionBy("doc_id", "row_key", "item_id").orderBy("b_pos")) - F.col("b_pos")
    covered = (places.withColumn("new", F.least(F.coalesce(following, F.lit(WIDTH)), F.lit(WIDTH)))
               .groupBy("doc_id", "row_key", "item_id")
               .agg(F.sum("new").alias("covered"), F.max("n_slots").alias("n_slots"), F.max("reworded").alias("reworded")))
    sized = items.groupBy("item_id").agg(F.max(F.size("words")).cast("long").alias("item_words"))
    share = F.col("covered") / F.col("item_words")
    return (covered.join(sized, "item_id").withColumn("share", share)
            .where((F.col("share") >= MIN_SHARE) | (F.col("covered") >= MIN_RUN))
            .select("doc_id", "item_id.item_id", "row_key", "covered", "item_words", "share", "n_slots", "reworded"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns unchanged.

    Null and empty texts hold none and stay; repeated rows stay or go together; a
    null doc_id is an id like others.
    """
    name = fresh_name(docs.columns, "row_key")
    found = cut_lineage(contaminated(docs.select("doc_id", "text"), benchmark).select(F.col("row_key").alias(name)).distinct(), shrink=8)
    return docs.withColumn(name, F.xxhash64("doc_id", "text")).join(found, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
