"""Before and after: classified changes of keyed snapshots, field by field, and comparison of value lists."""

from __future__ import annotations

from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.clean import cut, fold_spaces
from ..sources.sheets import shared_folder


def snapshot(df: DataFrame, entity: str, keys: list[str], label: Column, fields: list[str], tie_break: str | None = None) -> DataFrame:
    """entity, key, label, fields (map): texts of active rows. ``tie_break`` joins the key where two rows share it."""
    key = F.array(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    if tie_break:
        shared = F.count("*").over(Window.partitionBy(*keys)) > 1
        key = F.when(shared, F.concat(key, F.array(F.coalesce(F.col(tie_break).cast("string"), F.lit(""))))).otherwise(key)
    pairs = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields)))
    return df.select(F.lit(entity).alias("entity"), key.alias("key"), label.alias("label"), pairs.alias("fields"))


def changes(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, change_type (NEW, MODIFIED, REMOVED), n_fields: null and empty are equal, unchanged keys don't appear."""
    old = before.select(*keys, F.struct(*fields).alias("o"), F.lit(True).alias("is_old"))
    new = after.select(*keys, F.struct(*fields).alias("n"), F.lit(True).alias("is_new"))
    text = lambda side, f: F.coalesce(F.col(f"{side}.{f}").cast("string"), F.lit(""))
    n = sum((F.when(text("o", f) != text("n", f), 1).otherwise(0) for f in fields), F.lit(0))
    kind = F.when(F.col("is_old").isNull(), "NEW").when(F.col("is_new").isNull(), "REMOVED").when(n > 0, "MODIFIED")
    return old.join(new, keys, "full_outer").select(*keys, kind.alias("change_type"), F.when(kind == "MODIFIED", n).otherwise(0).alias("n_fields")).filter("change_type is not null")


def field_changes(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, field, old, new of keys that both sides have, where the texts differ."""
    text = lambda f: F.coalesce(F.col(f).cast("string"), F.lit(""))
    old = before.select(*keys, *(text(f).alias(f"o_{f}") for f in fields))
    new = after.select(*keys, *(text(f).alias(f"n_{f}") for f in fields))
    told = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"o_{f}").alias("old"), F.col(f"n_{f}").alias("new")) for f in fields)))
    return old.join(new, keys).select(*keys, told.alias("c")).select(*keys, "c.*").filter(F.col("old") != F.col("new"))


def change_summary(changed: DataFrame, sections: DataFrame, section: str) -> DataFrame:
    """Every section, changed or not, with the counts of the three kinds."""
    counts = changed.groupBy(section).agg(*(F.count_if(F.col("change_type") == k).alias(k.lower()) for k in ("NEW", "MODIFIED", "REMOVED")))
    return sections.join(counts, section, "left").na.fill(0, ["new", "modified", "removed"])


def first_rows(df: DataFrame, section: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each section and how many more there are. All rows are ranked; Spark keeps the first n of a group as it ranks."""
    w = Window.partitionBy(section)
    ranked = df.withColumn("rank", F.row_number().over(w.orderBy(*order)))
    more = df.groupBy(section).agg(F.greatest(F.count("*") - n, F.lit(0)).alias("n_more"))
    return ranked.filter(F.col("rank") <= n).join(more, section)


def shortened(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: cut(F.col(c), n) for c, n in limits.items()})


def compare_lists(template: DataFrame, catalogue: DataFrame, ratio: float = 0.75) -> DataFrame:
    """group, value, status, partner: MISSING in the catalogue, EXTRA there, EQUIVALENT but for case and accents, or possible TYPO.

    template: group, value, pos; catalogue: group, value. Exact matches go first, by joins. Of what is left, the template's values choose
    in list order: an equivalent partner first, else the closest at ``ratio`` or more, of equally close ones the last in order; each
    partner serves once. Groups without any catalogue report nothing; the blank marker never counts.
    """
    listed = template.filter("value is not null and value <> '-'").groupBy("group", "value").agg(F.min("pos").alias("pos"))
    known = catalogue.filter("value is not null").select("group", "value").distinct()
    missing = listed.join(known, ["group", "value"], "left_anti").join(known.select("group").distinct(), "group", "left_semi").withColumn("folded", fold_spaces(F.col("value")))
    extra = known.join(listed, ["group", "value"], "left_anti").select("group", F.col("value").alias("partner"), fold_spaces(F.col("value")).alias("like"))
    keep_checkpoints(template.sparkSession)
    missing, extra = missing.checkpoint(), extra.checkpoint()
    chosen = best_partners(missing, extra, ratio)
    status = F.when(F.col("partner").isNull(), "MISSING").when(F.col("same"), "EQUIVALENT").otherwise("TYPO")
    told = missing.join(chosen, ["group", "value"], "left").select("group", "value", status.alias("status"), "partner")
    unused = extra.join(chosen, ["group", "partner"], "left_anti").select("group", F.col("partner").alias("value"), F.lit("EXTRA").alias("status"), F.lit(None).cast("string").alias("partner"))
    return told.unionByName(unused)


#: Rounds in which only values that need them look for all their partners; after that all values do.
ASK_ROUNDS = 4


def best_partners(missing: DataFrame, extra: DataFrame, ratio: float) -> DataFrame:
    """group, value, partner, score, same: what values choose in list order (``first_come``).

    Partners that differ in no letter, or have one more or less, are found by joins, and no others come before them. So a value that gets one
    of these needs no others; one that gets none of them looks for all, which may take another value's partner, so that one looks, too.
    """
    def wishes(scored: DataFrame, values: DataFrame) -> DataFrame:
        same = F.col("folded") == F.col("like")
        return values.join(scored, ["group", "folded"]).join(extra, ["group", "like"]).select("group", "value", "pos", "partner", "like", "score", same.alias("same"))

    likes = extra.select("group", F.col("like").alias("folded"))
    first = wishes(near_texts(missing.select("group", "folded"), likes, ratio), missing).checkpoint()
    chosen = first_come(first).checkpoint()
    asking = missing.join(chosen, ["group", "value"], "left_anti").checkpoint()
    new = asking
    for left in range(ASK_ROUNDS, 0, -1):
        if new.isEmpty():
            break
        if left == 1:
            asking = missing
        found = wishes(close_texts(asking.select("group", "folded"), likes, ratio), asking).checkpoint()
        if found.isEmpty():
            break
        chosen = first_come(found.unionByName(first.join(asking, ["group", "value"], "left_anti"))).checkpoint()
        new = missing.join(chosen, ["group", "value"], "left_anti").join(asking, ["group", "value"], "left_anti").checkpoint()
        asking = asking.unionByName(new)
    return chosen


def keep_checkpoints(spark: SparkSession) -> None:
    """Where spark.checkpoint.dir is unset, checkpoints go to a new folder in the shared one."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def numbered(parts: Column) -> Column:
    """The parts in order, numbered where they repeat. They are sorted once: as an array of one array, whose element has a name."""
    each = lambda told: F.transform(told, lambda c, i: F.concat(c, F.lit("\0"), (i - F.array_position(told, c) + 1).cast("string")))
    return F.transform(F.array(F.array_sort(parts)), each)[0]


def grams(text: Column, q: int) -> Column:
    """A text's runs of q letters, numbered where they repeat."""
    return F.when(F.length(text) >= q, numbered(F.transform(F.sequence(F.lit(1), F.length(text) - q + 1), lambda i: F.substring(text, i, F.lit(q))))).otherwise(F.array().cast("array<string>"))


def shared_pairs(n: Column, m: Column, ratio: float) -> Column:
    """How many runs of two letters two texts of n and m letters have in common at least, if their ratio reaches ``ratio``.

    A ratio of r takes k = r * (n + m) / 2 letters in matching blocks. Between two blocks a letter is left over in one of the texts, and
    n + m - 2 * k are; so there is one block more than that at most, and each block of b letters has b - 1 pairs.
    """
    return F.ceil((1.5 * ratio - 1) * (n + m) - 1 - 1e-9)


def text_keys(texts: DataFrame, ratio: float) -> DataFrame:
    """group, folded, key: what two texts share at least one of if their ratio reaches ``ratio``.

    Of n - 1 pairs of letters, c must be shared: then the n - c rarest in the group have one of them. For short texts, of which none need
    be shared, every two of the rarest letters.
    """
    least = F.greatest(F.lit(1), F.ceil(F.length("folded") * ratio / (2 - ratio) - 1e-9))
    short = 1 / (1.5 * ratio - 1)  # up to this many letters in both together no pair need be shared
    n = F.length("folded")

    def rarest(q: int, kept: Column, some: Column) -> DataFrame:
        each = texts.filter(some).distinct().select("group", "folded", F.explode(grams(F.col("folded"), q)).alias("part"))
        counts = each.groupBy("group", "part").agg(F.count("*").alias("times"))
        ranked = each.join(counts, ["group", "part"]).groupBy("group", "folded").agg(F.array_sort(F.collect_list(F.struct("times", "part"))).alias("by"))
        return ranked.select("group", "folded", F.slice("by.part", 1, F.greatest(kept, F.lit(0)).cast("int")).alias("rare"))

    other = F.greatest(least, F.floor(F.lit(short)) + 1 - n)
    pairs = rarest(2, n - F.greatest(F.lit(1), shared_pairs(n, other, ratio)), n > 1).select("group", "folded", F.explode("rare").alias("key"))
    letters = rarest(1, n - F.greatest(F.lit(2), least) + 2, (n > 1) & (n + least <= short))
    two = F.explode(F.expr("flatten(transform(rare, (x, i) -> transform(slice(rare, i + 2, size(rare)), y -> concat_ws('\u0001', x, y))))"))
    return pairs.unionByName(letters.select("group", "folded", two.alias("key")))


def scored_pairs(met: DataFrame, ratio: float) -> DataFrame:
    """Pairs (group, folded, like) with their score, where it reaches ``ratio``."""
    def score(batches):
        for b in batches:
            found = []
            for x, y in zip(b["folded"], b["like"], strict=True):
                s = SequenceMatcher(None, y, x)
                # letters in common bound the ratio, and are counted first
                found.append(s.ratio() if s.quick_ratio() >= ratio else 0.0)
            b["score"] = found
            yield b

    return met.mapInPandas(score, StructType([*met.schema, StructField("score", DoubleType())])).filter(F.col("score") >= ratio)


def equal_texts(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.distinct().join(right.distinct(), ["group", "folded"]).select("group", "folded", F.col("folded").alias("like"), F.lit(1.0).alias("score"))


#: Letters of the texts that are looked up with each letter left out; of longer ones only equal texts are near.
NEAR_LETTERS = 64


def near_texts(left: DataFrame, right: DataFrame, ratio: float) -> DataFrame:
    """group, folded (of left), like (of right), score: of each left text the pairs that no other pair of it reaches in score, as far as they
    are equal or have one letter more or less.

    Texts of n and m letters that differ in d letters, left out or put in, have a ratio of (n + m - d) / (n + m) at most, and m is n + d at
    most: with two letters or more it is n / (n + 1). Pairs above that are kept; all of them are here.
    """
    def without_letter(texts: DataFrame, up_to: int) -> DataFrame:
        cut = F.transform(F.sequence(F.lit(1), F.length("folded")), lambda i: F.concat(F.substring("folded", F.lit(1), i - 1), F.substring("folded", i + 1, F.length("folded"))))
        some = texts.distinct().filter(F.length("folded").between(1, up_to))
        return some.select("group", "folded", F.explode(F.array_distinct(cut)).alias("rest"))

    l, r = left.select("group", "folded").distinct(), right.select("group", "folded").distinct()  # noqa: E741
    fewer = without_letter(l, NEAR_LETTERS).join(r.withColumnsRenamed({"folded": "like"}), ["group"]).filter(F.col("rest") == F.col("like")).select("group", "folded", "like")
    short = l.filter(F.length("folded") <= NEAR_LETTERS)
    more = without_letter(r, NEAR_LETTERS + 1).withColumnsRenamed({"folded": "like"}).join(short, ["group"]).filter(F.col("rest") == F.col("folded")).select("group", "folded", "like")
    n = F.length("folded")
    others = F.when(n <= NEAR_LETTERS, n / (n + 1)).otherwise(2 * n / (2 * n + 1))
    return equal_texts(left, right).unionByName(scored_pairs(fewer.unionByName(more), ratio)).filter(F.col("score") > others + 1e-9)


def close_texts(left: DataFrame, right: DataFrame, ratio: float) -> DataFrame:
    """group, folded (of left), like (of right), score: pairs of equal texts (score 1) and of texts whose ratio reaches ``ratio``.

    left, right: group, folded. Only texts that share a key and fit in length meet; their common letters are counted before the ratio
    itself is taken, in batches of pairs. ratio: above 2 / 3.
    """
    if not 2 / 3 < ratio <= 1:
        raise ValueError("ratio: above 2 / 3, up to 1")
    # one order of keys for both sides
    keyed = text_keys(left.select("group", "folded").union(right.select("group", "folded")), ratio)
    l = keyed.join(left.distinct(), ["group", "folded"], "left_semi").alias("l")  # noqa: E741
    r = keyed.join(right.distinct(), ["group", "folded"], "left_semi").alias("r")
    enough = F.lit(ratio) * (F.length("l.folded") + F.length("r.folded")) / 2 - 1e-9
    keys = [F.col("l.group") == F.col("r.group"), F.col("l.key") == F.col("r.key"), F.col("l.folded") != F.col("r.folded"), F.least(F.length("l.folded"), F.length("r.folded")) >= enough]
    met = l.join(r, keys).select(F.col("l.group").alias("group"), F.col("l.folded").alias("folded"), F.col("r.folded").alias("like")).distinct()

    return equal_texts(left, right).unionByName(scored_pairs(met, ratio))


#: Rounds of linking in which pairs fall into groups; what isn't settled by then keeps its list as its group.
LINK_ROUNDS = 6


def pair_groups(pairs: DataFrame) -> DataFrame:
    """pairs with ``part``: values and partners that hang together have the same. Every pair's value and partner take the least part of
    those that they meet, in a fixed number of rounds; a list in which parts still change is one part."""
    rows = pairs.withColumn("part", F.xxhash64("group", "value")).checkpoint()
    by = lambda side: Window.partitionBy("group", side)
    for _ in range(LINK_ROUNDS):
        rows = rows.withColumn("part", F.min("part").over(by("value"))).withColumn("part", F.min("part").over(by("partner")))
    rows = rows.checkpoint()
    apart = rows.groupBy("group", "value").agg((F.min("part") != F.max("part")).alias("open")).groupBy("group").agg(F.max("open").alias("open"))
    return rows.join(apart, "group").withColumn("part", F.when(F.col("open"), F.xxhash64("group")).otherwise(F.col("part"))).drop("open")


def first_come(pairs: DataFrame) -> DataFrame:
    """Of pairs (group, value, pos, partner, like, score, same) those that come about if values choose the best partner left, by pos and value.

    Every value's wishes pass in order through the task of its part, which remembers the partners that are taken and nothing else: a fixed
    number of jobs, however many values are equally close.
    """
    keep_checkpoints(pairs.sparkSession)
    grouped = pair_groups(pairs)
    wishes = grouped.repartition("part").sortWithinPartitions("part", "pos", "value", F.desc("score"), F.desc("like"), F.when(F.col("same"), F.col("partner")), F.desc("partner"))

    def settle(batches):
        part, value, taken, served = None, None, set(), True
        for b in batches:
            keep = []
            for p, v, g, partner in zip(b["part"], b["value"], b["group"], b["partner"], strict=True):
                if p != part:
                    part, value, taken = p, None, set()
                if (g, v) != value:
                    value, served = (g, v), False
                won = not served and (g, partner) not in taken
                if won:
                    served = True
                    taken.add((g, partner))
                keep.append(won)
            yield b[keep]

    return wishes.mapInPandas(settle, wishes.schema).drop("part", "like")


def list_states(compared: DataFrame, groups: DataFrame) -> DataFrame:
    """Each group's state: differences, only spelling, or fine."""
    g = compared.groupBy("group").agg(F.count_if(F.col("status") != "EQUIVALENT").alias("n_differences"), F.count_if(F.col("status") == "EQUIVALENT").alias("n_equivalent"))
    told = groups.join(g, "group", "left").na.fill(0, ["n_differences", "n_equivalent"])
    return told.withColumn("state", F.when(F.col("n_differences") > 0, "DIFFERENCES").when(F.col("n_equivalent") > 0, "SPELLING").otherwise("OK"))


def seed_candidates(compared: DataFrame, simple_groups: DataFrame) -> DataFrame:
    """Values to add to simple catalogues: missing ones, without typos and spellings."""
    return compared.filter("status = 'MISSING'").join(simple_groups, "group", "left_semi").select("group", "value")


def reference_lists(catalogue: DataFrame, template: DataFrame) -> DataFrame:
    """group, value, source: the catalogue's values; a group without catalogue keeps the template's."""
    own = catalogue.filter("value is not null").select("group", "value").distinct().withColumn("source", F.lit("catalogue"))
    kept = template.filter("value is not null").select("group", "value").distinct().join(own.select("group").distinct(), "group", "left_anti")
    return own.unionByName(kept.withColumn("source", F.lit("template")))
