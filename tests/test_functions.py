import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.functions.bands import above, above_or_false, order_tier, revenue_tier
from skyledger.functions.dates import calendar_parts, day_series
from skyledger.functions.numbers import (
    cents_to_dollars,
    price,
    price_text,
    round_even,
    round_sql,
    to_double,
    to_whole,
)
from skyledger.functions.sums import EVERY, exact_avg, exact_sum, exact_sum_by, merge_states, state_sum, sum_state
from skyledger.functions.text import blank_to_null, slug, sql_tidy, sql_trim, strip
from skyledger.operators.cleaning import normalize_list


def apply(spark, values, expression, kind="string"):
    """The expression over a column `v`, in the order of the values."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_trims_differ(spark):
    values = [" a ", "\ta\n", " a　", "\x1fa", None, "  "]
    assert apply(spark, values, sql_trim) == ["a", "\ta\n", "a", "\x1fa", None, ""]
    assert apply(spark, values, strip) == ["a", "a", "a", "a", None, ""]


def test_tidy_keeps_inner_text(spark):
    assert apply(spark, ["  Kuwait City ", " É A "], sql_tidy) == ["kuwait city", "é a"]


def test_blank_to_null_keeps_other_cells_untouched(spark):
    assert apply(spark, ["", " \t", " x ", None], blank_to_null) == [None, None, " x ", None]


def test_slug(spark):
    assert apply(spark, [" Kuwait City ", "a  b", None], slug) == ["kuwait_city", "a__b", None]
    df = spark.createDataFrame([(["A b", " C"],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(normalize_list("v", slug)).collect()] == [["a_b", "c"], []]


@pytest.mark.parametrize(
    "text, value",
    [
        ("N/A", None), ("", None), (None, None), ("$1,234.50", 1234.5), ("-5", 5.0),
        ("-5.5", -5.5), ("12.", 12.0), ("1.2.3", 1.2), ("1e3", 1.0), ("  ", None),
        ("EUR +.5 now", 0.5), ("١٢.٥ AED", 12.5), ("9" * 400, math.inf),
    ],
)
def test_price(spark, text, value):
    assert apply(spark, [text], price_text) == [value]


def test_price_of_numbers_passes_through(spark):
    df = spark.createDataFrame([(15,), (-5,)], "v int")
    assert [r[0] for r in df.select(price(df, "v")).collect()] == [15.0, -5.0]


def test_price_of_json_values_depends_on_their_kind(spark):
    values = ['-5', '"-5"', '"12 EUR"', 'true', 'null', '[1]', '1.25']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    df = df.withColumn("v", F.parse_json("v"))
    found = [r[0] for r in df.orderBy("i").select(price(df, "v")).collect()]
    assert found == [-5.0, 5.0, 12.0, 1.0, None, None, 1.25]


def test_to_double_refuses_what_only_spark_takes(spark):
    texts = ["abc", "", "0x10", "1,000", "1d", "1f", "1_000", "0x1p3", None]
    assert apply(spark, texts, to_double) == [None] * len(texts)
    good = [" 45.5 ", "1e3", ".5", "5.", "+7", "-2"]
    assert apply(spark, good, to_double) == [45.5, 1000.0, 0.5, 5.0, 7.0, -2.0]
    assert math.isnan(apply(spark, ["nan"], to_double)[0])
    assert apply(spark, ["-inf"], to_double) == [-math.inf]


def test_to_whole_rounds_like_sql(spark):
    texts = ["7", " 45.6", "46.5", "1e2", "abc", "-0.5", "1e30", "nan", "9007199254740993"]
    expected = [7, 46, 47, 100, None, -1, None, None, 9007199254740993]
    assert apply(spark, texts, to_whole) == expected


def test_rounding_ties(spark):
    sql = apply(spark, [1.005, 2.675, -0.125, 0.25], lambda c: round_sql(c, 2), "double")
    assert sql == [1.0, 2.68, -0.13, 0.25]
    even = apply(spark, [0.25, 0.35, -0.25, 29.05], lambda c: round_even(c, 1), "double")
    assert even == [0.2, 0.4, -0.2, 29.0]
    assert apply(spark, [1234.0, 5.0], cents_to_dollars, "double") == [12.34, 0.05]


def test_bands_and_flags(spark):
    values = [100.0, 99.9, 50.0, 49.9, None]
    assert apply(spark, values, order_tier, "double") == ["high", "medium", "medium", "low", "low"]
    tiers = apply(spark, values, lambda c: revenue_tier(c, 100, 50), "double")
    assert tiers == ["high", "med", "med", "low", "low"]
    assert apply(spark, [50.0, 50.1, None], lambda c: above(c, 50), "double") == [False, True, None]
    flags = apply(spark, [50.0, 50.1, None], lambda c: above_or_false(c, 50), "double")
    assert flags == [False, True, False]


def test_calendar(spark):
    days = day_series(spark, "2026-09-01", "2026-09-30")
    parts = days.select(*(c.alias(n) for n, c in calendar_parts(F.col("date")).items()))
    first = parts.orderBy("date").first()
    assert (first.date_key, first.day_of_week, first.week_number) == (20260901, "Tuesday", 36)
    assert (first.month_name, first.quarter, first.year) == ("September", 3, 2026)
    assert parts.count() == 30 and parts.where("is_weekend").count() == 8


def total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(exact_sum("v"), exact_avg("v")).first()


def test_exact_sum_does_not_drift(spark):
    assert total(spark, [0.1] * 10 + [None])[0] == 1.0
    assert total(spark, [0.1] * 10)[1] == 0.1
    assert tuple(total(spark, [None])) == (None, None)


def test_exact_sum_falls_back_off_the_grid(spark):
    assert total(spark, [1e-9, 1e-9])[0] == 2e-9
    assert total(spark, [1e300, 1.0])[0] == 1e300
    assert math.isnan(total(spark, [math.nan, 1.0])[0])
    assert total(spark, [math.inf, 1.0])[0] == math.inf
    assert total(spark, [9e11] * 2000)[0] == 1.8e15


def mixed_doubles(seed):
    """Values of all sizes, many of which cancel each other."""
    rnd = random.Random(seed)
    sets = [
        [1e300, -1e300, 1e-300], [5e-324] * 3, [-(2.0**63), 2.0**63, 0.5], [1.7e308, 1.7e308, -1.7e308],
        [1e16, 1.0, -1e16, 1e-5], [0.0], [-0.1, 0.1], [2.0**62] * 9, [1e-12, 1e300, -1e300, 1e-12],
    ]
    for low, high in ((-12, 300), (-12, 18), (-323, -300), (-323, 300), (-9, 9)):
        for _ in range(12):
            sets.append([rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randint(low, high) for _ in range(30)])
    for _ in range(12):
        values = [rnd.random() * 2.0 ** rnd.randint(-1074, 1000) for _ in range(8)]
        sets.append([*values, *(-v for v in values), rnd.random()])
    rows = [(i, v) for i, values in enumerate(sets) for v in values]
    rnd.shuffle(rows)
    return {i: math.fsum(values) if i != 3 else 1.7e308 for i, values in enumerate(sets)}, rows


def test_exact_sum_of_every_double_equals_fsum(spark):
    expected, rows = mixed_doubles(1)
    df = spark.createDataFrame(rows, "g int, v double").repartition(4)
    found = dict(df.groupBy("g").agg(exact_sum("v", reach=EVERY)).collect())
    assert found == expected
    # The same through partial sums, merged in another order and with one part taken away again.
    parts = df.groupBy("g", F.pmod(F.hash("v"), F.lit(3)).alias("h")).agg(sum_state("v", EVERY).alias("s"))
    extra = parts.where("h = 0").select("g", "h", "s", F.explode(F.array(F.lit(1), F.lit(-1))).alias("sign"))
    signed = parts.withColumn("sign", F.lit(1)).unionByName(extra)
    merged = signed.groupBy("g").agg(merge_states("s", sign=F.col("sign"), reach=EVERY).alias("s"))
    assert dict(merged.select("g", state_sum("s", EVERY)).collect()) == expected


def test_exact_sum_by_group_equals_fsum_and_adds_few_columns_per_value(spark):
    expected, rows = mixed_doubles(3)
    rows += [(None, 1e300), (None, 1e-300), (None, -1e300), (-1, None), (-2, math.inf), (-2, 1.0), (-3, math.inf), (-3, -math.inf)]
    expected |= {None: 1e-300, -1: None, -2: math.inf}
    df = spark.createDataFrame(rows, "g int, v double").repartition(4)
    summed = exact_sum_by(df, ["g"], "v", "s")
    found = dict(summed.collect())
    assert math.isnan(found.pop(-3)) and found == expected
    assert exact_sum_by(df.where("g < -9"), [], "v", "s").collect() == [(None,)]
    assert exact_sum_by(df.where("g = 0"), [], "v", "s").collect() == [(expected[0],)]
    # Values themselves are added up per place, in 13 columns, and not in 43.
    first = summed._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [")[-1]
    assert "_place" in first and first.count("sum(") <= 13


def test_exact_sum_of_amounts_equals_fsum(spark):
    rnd = random.Random(2)
    sets = {g: [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randint(-8, 18) for _ in range(200)] for g in range(40)}
    sets |= {g: [round(rnd.random() * 300, 2) for _ in range(rnd.randrange(1, 90))] for g in range(40, 80)}
    rows = [(g, v) for g, values in sets.items() for v in values]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    assert dict(df.groupBy("g").agg(exact_sum("v")).collect()) == {g: math.fsum(v) for g, v in sets.items()}
    ordered = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = df.where("g < 5").select("g", "v", exact_sum("v", ordered).alias("s")).collect()
    for r in running:
        assert r["s"] == math.fsum(v for v in sets[r["g"]] if v <= r["v"])


def test_merged_states_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, 1.5)], "g int, v double")
    states = df.groupBy("g").agg(sum_state("v").alias("s")).withColumn("sign", F.lit(1))
    gone = states.unionByName(states.withColumn("sign", F.lit(-1)))
    for frame, total in ((states, 1.5), (gone, None)):
        merged = frame.groupBy("g").agg(merge_states("s", sign=F.col("sign")).alias("s"))
        assert dict(merged.select("g", state_sum("s")).collect()) == {1: None, 2: total}
