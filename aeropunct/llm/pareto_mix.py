"""Mixing sources to target weights by Pareto order sampling (Rosén, 1997)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeropunct.llm.common import WORD, Scratch
from aeropunct.llm.components import ranked

# Sources in code point order, null last, weigh these by turns (fixed values).
WEIGHTS = (3, 1, 2)
# Words of the mix per word of input, and how often a document may be used.
SHARE, MOST_COPIES = 1.5, 2
# Documents of at least so many words are twice as likely to be sampled as others.
FULL_WORDS = 50
# Intervals into which the order keys of a source are counted before they are ranked.
INTERVALS = 16_384


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds size, importance, a digest of the row, from which its random number comes, and
    a number of its own, which tells rows of one digest apart."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source", "text")]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return (
        docs.withColumn("_size", words(F.col("text")))
        .withColumn("_importance", F.when(F.col("_size") >= FULL_WORDS, 2).otherwise(1))
        .withColumn("_digest", digest)
        .withColumn("_own", F.xxhash64(F.monotonically_increasing_id()))
    )


def _order_key(expected: Column) -> Column:
    """Random odds divided by the odds of inclusion, for the fraction of ``expected``."""
    draw = (F.conv(F.substring("_digest", 1, 12), 16, 10).cast("double") + 0.5) / F.lit(2.0**48)
    part = expected - F.floor(expected)
    return F.when(part > 0, draw / (1 - draw) * ((1 - part) / part))


def _interval(key: Column) -> Column:
    return F.floor(F.lit(INTERVALS) * (key / (1 + key)))


@dataclass
class Mix:
    """What decides each row: one row a source and importance.

    Columns: _source, _importance, source_size, target, _whole copies of every
    document, the _expected copies, and where the sample ends: the interval _cut, inside
    it the key and digest _last, and of the rows that share these the own number _upto
    (null: all of them).
    """

    plan: DataFrame

    def copies(self, docs: DataFrame) -> DataFrame:
        """``docs(doc_id, source, text, ...)`` with _size, _copies, source_size and target.

        The plan has two rows a source; nothing else is joined, so the rows are not
        shuffled unless the plan is too large to broadcast. Rows are told apart by their
        places: ``docs`` should be read from the files that the mix was planned on.
        """
        return _apply(_keyed(docs), self.plan)


def _apply(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    key = _order_key(F.col("_expected"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_importance") == F.col("_level"))
    joined = keyed.join(plan, same, "left").withColumn("_key", key)
    place = _interval(F.col("_key"))
    here = F.struct(F.col("_key"), F.col("_digest"))
    some = F.col("_upto").isNull() | (F.col("_own") <= F.col("_upto"))
    inside = (here < F.col("_last")) | ((here == F.col("_last")) & some)
    picked = (place < F.col("_cut")) | ((place == F.col("_cut")) & F.coalesce(inside, F.lit(False)))
    copies = F.col("_whole") + F.coalesce(picked, F.lit(False)).cast("int")
    return joined.withColumn("_copies", copies.cast("int")).drop(
        "_source", "_level", "_key", "_cut", "_last", "_upto", "_whole", "_expected", "_importance",
        "_digest", "_own",
    )


def _targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Target of each source: its weight's share, at most ``most`` times its size.

    What the limit cuts off is dealt out again by weight until no source is above;
    each round returns two sums to the driver.
    """
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighted = sources.withColumn("_weight", turn).withColumn("_limit", most * F.col("_words"))
    total = (sources.agg(F.sum("_words")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("_limit") <= F.lit(level) * F.col("_weight")
        row = weighted.agg(
            F.sum(F.when(full, F.col("_limit")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("_weight"))),
            F.sum(full.cast("long")),
        ).first()
        if not row[1] or row[2] == capped:
            break
        capped, level = row[2], (total - row[0]) / row[1]
    share_of = F.lit(level) * F.col("_weight")
    return weighted.withColumn("target", F.least(F.col("_limit").cast("double"), share_of)).drop(
        "_rank", "_weight", "_limit"
    )


def _expected_copies(levels: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """Copies expected of a document of each importance: in proportion to it, at most
    ``most``, and in sum over the source's words its target."""
    by_source = Window.partitionBy("_source").orderBy(F.desc("_level"))
    above = by_source.rowsBetween(Window.unboundedPreceding, -1)
    below = by_source.rowsBetween(0, Window.unboundedFollowing)
    # If all levels above are at the limit, the others share what is left.
    left = F.col("target") - most * F.coalesce(F.sum("_words").over(above), F.lit(0))
    scale = F.try_divide(left, F.sum(F.col("_level") * F.col("_words")).over(below))
    joined = levels.join(
        targets.select(F.col("_source").alias("_s"), "target", F.col("_words").alias("source_size")),
        F.col("_source").eqNullSafe(F.col("_s")),
    ).drop("_s")
    free = joined.withColumn("_scale", scale).withColumn(
        "_full", F.coalesce(F.col("_scale") * F.col("_level") >= most, F.lit(False))
    )
    # The first level that is not at its limit sets the scale of those below it.
    whole = Window.partitionBy("_source")
    first = F.max(F.when(~F.col("_full"), F.col("_level"))).over(whole)
    common = F.max(F.when(F.col("_level") == first, F.col("_scale"))).over(whole)
    expected = F.when(F.col("_level") > first, float(most)).otherwise(
        F.coalesce(F.least(F.lit(float(most)), common * F.col("_level")), F.lit(float(most)))
    )
    return (
        free.withColumn("_expected", expected)
        .withColumn("_whole", F.floor("_expected"))
        .withColumn("_budget", F.col("target") - F.sum(F.col("_whole") * F.col("_words")).over(whole))
        .drop("_scale", "_full", "_words")
    )


def plan_mix(
    docs: DataFrame,
    scratch: Scratch,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> tuple[Mix, DataFrame]:
    """The mix of ``docs(doc_id, source, text)`` and the measured narrow rows.

    1. Sizes are counted in one pass over the texts; everything else is narrow.
    2. Sources get targets, documents expected copies; whole copies are certain.
    3. The fractions are sampled in Pareto order until the words fill the budget of
       the source; the prefix whose words are nearest is taken. The order keys of a
       source are counted in intervals, and only the interval in which the budget
       ends is ranked, so no task gets a source.
    """
    measured = scratch.keep(
        _keyed(docs.select("doc_id", "source", "text")).drop("text"), "measured"
    )
    levels = scratch.keep(
        measured.groupBy(F.col("source").alias("_source"), F.col("_importance").alias("_level")).agg(
            F.sum("_size").alias("_words")
        ),
        "levels",
    )
    sources = ranked(
        scratch,
        levels.groupBy("_source").agg(F.sum("_words").alias("_words")),
        F.col("_source").asc_nulls_last(),
    )
    targets = _targets(scratch.keep(sources, "sources"), weights, share, most)
    expected = scratch.keep(_expected_copies(levels, targets, most), "expected")

    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_importance") == F.col("_level"))
    keyed = (
        measured.join(expected.filter("_budget > 0"), same)
        .withColumn("_key", _order_key(F.col("_expected")))
        .filter("_key IS NOT NULL")
        .withColumn("_place", _interval(F.col("_key")))
        .select("_source", "_size", "_digest", "_key", "_place", "_budget")
    )
    counted = keyed.groupBy("_source", "_budget", "_place").agg(F.sum("_size").alias("_words"))
    running = Window.partitionBy("_source").orderBy("_place")
    before = F.coalesce(
        F.sum("_words").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # Intervals before the cut are taken whole; without a cut all are.
    cuts = scratch.keep(
        counted.withColumn("_before", before)
        .filter("_before <= _budget AND _budget < _before + _words")
        .select(F.col("_source").alias("_s"), F.col("_place").alias("_p"), "_before"),
        "cuts",
    )
    at_cut = keyed.join(
        cuts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_place") == F.col("_p"))
    )
    # Rows of one key and digest are one row here, however many they are.
    equal = at_cut.groupBy("_source", "_key", "_digest", "_size", "_budget", "_before").agg(
        F.count("*").alias("_rows")
    )
    inner = Window.partitionBy("_source").orderBy("_key", "_digest")
    so_far = F.col("_before") + F.coalesce(
        F.sum(F.col("_size") * F.col("_rows")).over(
            inner.rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    # A row is taken when the budget reaches the middle of its words.
    room = F.floor(2 * F.col("_budget")) - 2 * F.col("_so_far") - F.col("_size")
    taken = F.when(F.col("_size") == 0, F.col("_rows")).otherwise(
        F.least(F.col("_rows"), F.floor(room / (2 * F.col("_size"))) + 1)
    )
    ends = scratch.keep(
        equal.withColumn("_so_far", so_far)
        .filter("2 * _so_far + _size <= 2 * _budget")
        .withColumn("_taken", taken)
        .groupBy(F.col("_source").alias("_t"))
        .agg(F.max(F.struct("_key", "_digest", "_taken", "_rows")).alias("_end"))
        .select("_t", F.struct("_end._key", "_end._digest").alias("_last"), "_end._taken", "_end._rows"),
        "ends",
    )
    last = ends.select("_t", "_last").join(
        _part_of_equal_rows(scratch, measured, ends), F.col("_t").eqNullSafe(F.col("_u")), "left"
    )
    plan = (
        expected.join(cuts, F.col("_source").eqNullSafe(F.col("_s")), "left")
        .join(last, F.col("_source").eqNullSafe(F.col("_t")), "left")
        .withColumn("_cut", F.when(F.col("_budget") > 0, F.coalesce("_p", F.lit(INTERVALS + 1))).otherwise(-1))
        .drop("_s", "_p", "_before", "_t", "_u", "_budget")
    )
    return Mix(scratch.keep(plan, "plan")), measured


def _part_of_equal_rows(scratch: Scratch, measured: DataFrame, ends: DataFrame) -> DataFrame:
    """(_u, _upto): own number up to which the equal rows at the end are taken, by source.

    The rows of one digest may be a third of the table, so their own numbers are counted
    in intervals too, and only the interval that holds the last row taken is ranked.
    """
    part = ends.filter("_taken < _rows").select(
        F.col("_t").alias("_u"), F.col("_last._digest").alias("_d"), "_taken"
    )
    same = F.col("source").eqNullSafe(F.col("_u")) & (F.col("_digest") == F.col("_d"))
    bits = 63 - (INTERVALS.bit_length() - 2)
    rows = measured.join(part, same).select(
        "_u", "_taken", "_own", F.shiftright("_own", bits).alias("_slot")
    )
    slots = rows.groupBy("_u", "_taken", "_slot").agg(F.count("*").alias("_n"))
    running = Window.partitionBy("_u").orderBy("_slot")
    before = F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, -1))
    cut = (
        slots.withColumn("_before", F.coalesce(before, F.lit(0)))
        .filter("_before < _taken AND _taken <= _before + _n")
        .select(F.col("_u").alias("_v"), F.col("_slot").alias("_w"), "_before")
    )
    there = rows.join(cut, F.col("_u").eqNullSafe(F.col("_v")) & (F.col("_slot") == F.col("_w")))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_u").orderBy("_own"))
    found = there.withColumn("_place", place).filter("_place = _taken")
    return scratch.keep(found.select("_u", F.col("_own").alias("_upto")), "part")


def mixed(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every document.

    A source's size is the sum of its documents' words, its target its share of the
    mix, and ``taken`` what the mix takes of a document with repeats. The words taken
    of a source differ from its target by less than a document.

    Null texts and sources are allowed: a null text has no words, null is a source of
    its own and comes last. Rows equal in id, source and text share their random number,
    so they follow each other in the order; where the target ends among them, as many of
    them are used as come nearest to it. An empty table gives an empty mix. The random
    numbers follow from the rows, so reruns agree on any cluster, but for which of several
    equal rows is used. Other columns are not read.
    """
    mix, measured = plan_mix(docs, Scratch(docs.sparkSession, "mix"))
    return _apply(measured, mix.plan).select(
        "doc_id",
        "source",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


ORACLE = f"""
WITH measured AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '') || '|' || coalesce(text, '')) AS digest
  FROM documents),
rows AS (
  SELECT *, CASE WHEN size >= {FULL_WORDS} THEN 2 ELSE 1 END AS level,
    (CAST(CAST('0x' || substr(digest, 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0 AS draw
  FROM measured),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words,
    [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM rows GROUP BY source),
limits AS (
  SELECT *, {MOST_COPIES} * words AS most, {SHARE} * CAST(sum(words) OVER () AS BIGINT) AS total,
    CAST(coalesce(sum({MOST_COPIES} * words) OVER before, 0) AS BIGINT) AS most_before,
    CAST(sum(weight) OVER rest AS BIGINT) AS weight_left,
    row_number() OVER (ORDER BY {MOST_COPIES}.0 * words / weight, encode(source) NULLS LAST) AS place
  FROM sources
  WINDOW before AS (ORDER BY {MOST_COPIES}.0 * words / weight, encode(source) NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY {MOST_COPIES}.0 * words / weight, encode(source) NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
water AS (
  SELECT arg_min((total - most_before) / weight_left, place) FILTER (
    WHERE most > (total - most_before) / weight_left * weight) AS mark FROM limits),
targets AS (
  SELECT source, words, CASE WHEN mark IS NULL THEN CAST(most AS DOUBLE)
    ELSE least(CAST(most AS DOUBLE), mark * weight) END AS target FROM limits, water),
levels AS (
  SELECT r.source, level, t.target, t.words AS source_size, CAST(sum(size) AS BIGINT) AS words
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
scales AS (
  SELECT *, (target - {MOST_COPIES} * CAST(coalesce(sum(words) OVER above, 0) AS BIGINT))
    / nullif(CAST(sum(level * words) OVER below AS BIGINT), 0) AS scale
  FROM levels
  WINDOW above AS (PARTITION BY source ORDER BY level DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    below AS (PARTITION BY source ORDER BY level DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
firsts AS (
  SELECT *, max(level) FILTER (WHERE NOT coalesce(scale * level >= {MOST_COPIES}, false))
    OVER (PARTITION BY source) AS free FROM scales),
commons AS (
  SELECT *, max(scale) FILTER (WHERE level = free) OVER (PARTITION BY source) AS common FROM firsts),
expected AS (
  SELECT *, CASE WHEN level > free THEN {MOST_COPIES}.0
    ELSE coalesce(least({MOST_COPIES}.0, common * level), {MOST_COPIES}.0) END AS copies FROM commons),
budgets AS (
  SELECT *, target - CAST(sum(floor(copies) * words) OVER (PARTITION BY source) AS BIGINT) AS budget
  FROM expected),
keyed AS (
  SELECT r.*, b.target, b.source_size, b.copies, b.budget, CASE WHEN b.copies - floor(b.copies) > 0 THEN
    draw / (1 - draw) * ((1 - (b.copies - floor(b.copies))) / (b.copies - floor(b.copies))) END AS key
  FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source AND r.level = b.level),
filled AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
  FROM keyed WHERE key IS NOT NULL AND budget > 0),
decided AS (
  SELECT doc_id, source, size, source_size, target, CAST(floor(copies) AS INTEGER)
    + CASE WHEN 2 * so_far + size <= 2 * budget THEN 1 ELSE 0 END AS copies FROM filled
  UNION ALL
  SELECT doc_id, source, size, source_size, target, CAST(floor(copies) AS INTEGER) FROM keyed
  WHERE key IS NULL OR budget <= 0)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target, copies,
  CAST(copies * size AS BIGINT) AS taken
FROM decided
"""
