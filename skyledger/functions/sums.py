"""Sums and averages of doubles that are exact until one last rounding.

Adding doubles rounds at every step, so the result depends on the order in which rows arrive. Here
every double is split without error into whole numbers by fixed windows of 63 binary digits. The
parts of a window are added as whole numbers, before the shuffle and after it, in any order. At the
end the windows are put together and rounded once, half to even. So a sum is the double next to
the true sum of its values, whatever their sizes and their order, over groups, windows and merged
partial sums alike.

Two windows are `near`: the digits of values below 2**63 down to the 63rd binary place. They are
kept as six sums of 21 digits each (room for 4e12 rows in a group). Larger values, and what is left
below the 63rd place, are `far`. With reach EVERY, the default, they go to 36 more windows that
reach every double; `exact_sum_by` gives the same sums per group, and carries the windows of a value alone
through the first of two steps, so use it for many rows. With reach NEAR, which is many times as fast and meant for money and
temperatures, they are added as doubles. That is exact too for values from 1e-9 to 9e18, as what is
left of them has few digits; beyond, nothing is lost, but last digits depend on the order of rows.

NaN and infinity give what adding doubles gives. A sum beyond the largest double is infinite.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from skyledger.functions.text import col

WINDOW = 63  # binary digits of a window
DIGIT = 21  # binary digits that are added together
LOWEST, HIGHEST = -19, 16  # windows; window k holds the digits from 2**(63 * k) on
_MASK = (1 << DIGIT) - 1
_SIZE = float(1 << WINDOW)
_WIDE = "decimal(38,0)"
DIGITS = [f"near{i}" for i in range(6)]  # lowest digits first
FAR = [f"far{i}" for i in range(HIGHEST - LOWEST + 1)]

NEAR, EVERY = "near", "every"  # reach
Aggregate = Callable[[Column], Column]


def _digits(whole: Column) -> list[Column]:
    """Three parts of a whole number, lowest first; the highest one carries the sign."""
    return [
        whole.bitwiseAND(_MASK),
        F.shiftright(whole, DIGIT).bitwiseAND(_MASK),
        F.shiftright(whole, 2 * DIGIT),
    ]


def _parts(x: Column, reach: str) -> dict[str, Column]:
    """What one double adds to each part of a state. The rest is zero where no digit is far."""
    large = F.abs(x) >= _SIZE  # so is NaN
    small = F.when(~large, x)
    whole = small.cast("bigint")
    behind = (small - whole.cast("double")) * _SIZE
    below = behind.cast("bigint")
    parts = dict(zip(DIGITS, [*_digits(below), *_digits(whole)]))
    parts["rest"] = F.when(large, x).otherwise((behind - below.cast("double")) / _SIZE)
    if reach == NEAR:
        return parts

    far = _far(x, parts["rest"])
    parts["rest"] = F.when(F.abs(x) < float("inf"), 0.0).otherwise(x)
    place = _place(far)
    scaled = _scaled(far, place)
    return parts | _windows(place, scaled.try_cast("bigint"), _below(scaled), "decimal(28,0)")


def _far(x: Column, rest: Column) -> Column:
    return F.when((rest != 0.0) & (F.abs(x) < float("inf")), rest)


def _place(far: Column) -> Column:
    """The upper one of the two windows that hold the digits of a far value.

    A value may count as one window too high, where its digits still fit into two.
    """
    return F.floor((F.log2(F.abs(far)) + 0.001) / WINDOW).cast("int")


def _scaled(far: Column, place: Column) -> Column:
    return far * F.pow(F.lit(2.0), place * -31) * F.pow(F.lit(2.0), place * -32)


def _below(scaled: Column) -> Column:
    return (scaled % 1.0 * _SIZE).try_cast("bigint")


def _windows(place: Column, upper: Column, lower: Column, kind: str) -> dict[str, Column]:
    return {
        name: F.when(place == i, upper).when(place == i + 1, lower).cast(kind)
        for i, name in enumerate(FAR, LOWEST)
    }


def _over(window: WindowSpec | None) -> Aggregate:
    return (lambda a: a) if window is None else (lambda a: a.over(window))


def _state(parts: dict[str, Column], count: Column, over: Aggregate) -> dict[str, Column]:
    """The aggregated parts: what a partial sum consists of."""
    state = {name: over(F.sum(part)) for name, part in parts.items()}
    return {**state, **{name: state[name].cast(_WIDE) for name in FAR if name in state}, "n": count}


def _near_sql() -> str:
    """The sum of a state `v`, as the text of an expression: it is long, and parsed in one step.

    The six sums of digits become whole numbers `high` and `low` (units of 1 and 2**-63), what is
    `left` of near values goes below them, and the first of three scales that keeps 61 binary digits
    is rounded: a cast rounds a decimal half to even, and with so many digits in front one more
    digit tells as much as all that follow it. `let` binds values that are named more than once.
    """
    wide = "cast({} AS decimal(38,0))".format
    size, few = f"{1 << WINDOW}BD", f"{1 << 61}BD"

    def let(name: str, values: dict[str, str], body: str) -> str:
        fields = ", ".join(f"'{k}', {v}" for k, v in values.items())
        return f"get(transform(array(named_struct({fields})), {name} -> {body}), 0)"

    def whole(digits: list[str]) -> str:
        terms = [f"cast(coalesce(v.{d}, 0) AS decimal(20,0)) * {1 << (DIGIT * i)}BD" for i, d in enumerate(digits)]
        return wide(" + ".join(terms))

    def rounded(number: str, more: str, exponent: int) -> str:
        twice = wide(f"{number} * 2 + cast({more} AS int)")
        return f"cast({twice} AS double) * {2.0 ** (exponent - 1)!r}D"

    both = wide(f"z.above * {size} + z.behind")
    deep = wide(f"{both} * {size} + floor(y.part)")
    scales = f"""CASE WHEN NOT y.known THEN {rounded("z.above", "z.behind <> 0", 0)} + v.rest
      WHEN abs(z.above) >= {few} THEN {rounded("z.above", "z.behind <> 0 OR y.part <> 0", 0)}
      WHEN abs({both}) >= {few} THEN {rounded(both, "y.part <> 0", -WINDOW)}
      ELSE {rounded(deep, "y.part % 1 <> 0", -2 * WINDOW)} END"""
    above, behind = wide("v1.high + y.carry"), f"y.now - y.carry * {size}"
    joined = let("z", {"above": above, "behind": wide(behind)}, scales)
    now = wide("v1.low + x.whole")
    carried = let(
        "y", {"now": now, "carry": wide(f"floor({now} / {size})"), "part": "x.part", "known": "x.known"}, joined
    )
    left = f"v.rest * {_SIZE!r}D"
    known = f"abs({left}) < {float(1 << 53)!r}D"
    split = let(
        "x",
        {
            "known": known,
            "whole": f"cast(if({known}, floor({left}), 0) AS decimal(20,0))",
            "part": f"if({known}, ({left} - floor({left})) * {_SIZE!r}D, 0D)",
        },
        carried,
    )
    return let("v1", {"high": whole(DIGITS[3:]), "low": whole(DIGITS[:3])}, split)


_NEAR_SQL = _near_sql()


def _let(value: Column, body: str) -> Column:
    """An expression over `v`, with a value that is worked out once however often it is named."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"v -> {body}")), 0)


def _total(state: dict[str, Column]) -> Column:
    """The sum; null where there was no value."""
    near = F.struct(*(state[name].alias(name) for name in DIGITS), state["rest"].alias("rest"))
    total = _let(near, f"CASE WHEN v.rest IS NOT NULL THEN {_NEAR_SQL} END")
    if FAR[0] in state:
        some = F.coalesce(*(state[name] for name in FAR)).isNotNull()
        total = F.when(some, _far_total(state) + state["rest"]).otherwise(total)
    return total


def _far_total(state: dict[str, Column]) -> Column:
    """All windows put together: carried from the lowest on, then read from the highest on."""
    zero = F.lit(Decimal(0)).cast(_WIDE)
    parts = {name: F.coalesce(state[name], zero) for name in FAR}
    for window, group in ((-1, DIGITS[:3]), (0, DIGITS[3:])):
        for i, digits in enumerate(group):
            amount = F.coalesce(state[digits], F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(1 << DIGIT * i))
            name = FAR[window - LOWEST]
            parts[name] = (parts[name] + amount).cast(_WIDE)
    size, enough = F.lit(Decimal(1 << WINDOW)), F.lit(Decimal(1 << 60))
    none = F.array().cast(f"array<{_WIDE}>")

    def carry(done: Column, part: Column) -> Column:
        now = (done["carry"] + part).cast(_WIDE)
        up = F.floor(now / size).cast(_WIDE)
        digit = (now - up * size).cast(_WIDE)
        return F.struct(up.alias("carry"), F.concat(F.array(digit), done["digits"]).alias("digits"))

    def take(done: Column, digit: Column) -> Column:
        full = F.abs(done["whole"]) >= enough
        return F.struct(
            F.when(full, done["whole"]).otherwise((done["whole"] * size + digit).cast(_WIDE)).alias("whole"),
            F.when(full, done["at"]).otherwise(done["at"] - 1).alias("at"),
            (done["more"] | (full & (digit != 0))).alias("more"),
        )

    def double(done: Column) -> Column:
        twice = (done["whole"] * 2 + done["more"].cast("int")).cast(_WIDE).cast("double")
        # In two steps, as neither may leave the range of doubles before the other.
        return twice * F.pow(F.lit(2.0), done["at"] * 31) * F.pow(F.lit(2.0), done["at"] * 32 - 1)

    carried = F.aggregate(
        F.array(*parts.values()),
        F.struct(zero.alias("carry"), none.alias("digits")),
        carry,
        lambda done: F.concat(F.array(done["carry"]), done["digits"]),
    )
    start = F.struct(zero.alias("whole"), F.lit(HIGHEST + 2).alias("at"), F.lit(False).alias("more"))
    return F.aggregate(carried, start, take, double)


def exact_sum(c: str | Column, window: WindowSpec | None = None, reach: str = NEAR) -> Column:
    return _total(_state(_parts(col(c).cast("double"), reach), F.lit(None), _over(window)))


def exact_sum_by(df: DataFrame, keys: Sequence[str], c: str | Column, name: str) -> DataFrame:
    """Per group the sum that exact_sum gives with reach EVERY, for any number of rows.

    Values are first added per group and place, where each has two far windows. So all windows
    stand side by side only in the second step, over as many rows as a group has places.
    """
    x = F.col("_x")
    parts = _parts(x, NEAR)
    split = df.select(*keys, col(c).cast("double").alias("_x"))
    split = split.select(*keys, x, *(part.alias(f"_{n}") for n, part in parts.items()))
    split = split.withColumn("_far", _far(x, F.col("_rest")))
    split = split.withColumn("_rest", F.when(F.abs(x) < float("inf"), 0.0).otherwise(x))
    split = split.withColumn("_place", _place(F.col("_far")))
    split = split.withColumn("_scaled", _scaled(F.col("_far"), F.col("_place")))
    split = split.withColumns(
        {"_upper": F.col("_scaled").try_cast("bigint"), "_lower": _below(F.col("_scaled"))}
    )
    sums = [F.sum(f"_{n}").alias(f"_{n}") for n in parts]
    for n in ("_upper", "_lower"):
        sums += [F.sum(d).alias(f"{n}{i}") for i, d in enumerate(_digits(F.col(n)))]
    placed = split.groupBy(*keys, "_place").agg(*sums)

    def whole(n: str) -> Column:
        terms = [F.col(f"{n}{i}").cast("decimal(20,0)") * F.lit(Decimal(1 << DIGIT * i)) for i in range(3)]
        return (terms[0] + terms[1] + terms[2]).cast(_WIDE)

    placed = placed.withColumns({n: whole(n) for n in ("_upper", "_lower")})
    parts = {n: F.col(f"_{n}") for n in parts}
    parts |= _windows(F.col("_place"), F.col("_upper"), F.col("_lower"), _WIDE)
    state = _state(parts, F.lit(None), _over(None))
    return placed.groupBy(*keys).agg(_total(state).alias(name))


def exact_avg(c: str | Column, window: WindowSpec | None = None, reach: str = NEAR) -> Column:
    count = _over(window)(F.count(col(c)))
    return exact_sum(c, window, reach) / F.nullif(count, F.lit(0))


def sum_state(c: str | Column, reach: str = NEAR) -> Column:
    """A partial sum as one column, to be stored and merged: its parts, flags and count."""
    return _packed(_state(_parts(col(c).cast("double"), reach), F.count(col(c)), _over(None)))


def _packed(state: dict[str, Column]) -> Column:
    fields = [F.array(*(state[name] for name in DIGITS)).alias("near"), state["rest"].alias("rest")]
    if FAR[0] in state:
        some = F.coalesce(*(state[name] for name in FAR)).isNotNull()
        fields.append(F.when(some, F.array(*(state[name] for name in FAR))).alias("far"))
    return F.struct(*fields, state["n"].alias("n"))


def _unpacked(state: Column, reach: str) -> dict[str, Column]:
    parts = {name: F.get(state["near"], i) for i, name in enumerate(DIGITS)}
    parts["rest"] = state["rest"]
    if reach == EVERY:
        parts |= {name: F.get(state["far"], i) for i, name in enumerate(FAR)}
    return parts


def merge_states(
    state: str | Column,
    window: WindowSpec | None = None,
    sign: Column | None = None,
    reach: str = NEAR,
) -> Column:
    """Partial sums added up; with a sign of -1, a partial sum is taken away again.

    NaN and infinity cannot be taken away: what is left of them is NaN.
    """
    over, state = _over(window), col(state)
    parts = _unpacked(state, reach)
    count = state["n"]
    if sign is not None:
        parts, count = {k: v * sign for k, v in parts.items()}, count * sign
    return _packed(_state(parts, over(F.sum(count)), over))


def state_sum(state: str | Column, reach: str = NEAR) -> Column:
    """The sum; null where no value was added, or all were taken away again."""
    return F.when(col(state)["n"] > 0, _total(_unpacked(col(state), reach)))


def state_avg(state: str | Column, reach: str = NEAR) -> Column:
    return state_sum(state, reach) / F.nullif(col(state)["n"], F.lit(0))
