"""Keyed building blocks: one row per key, lookups, counts, flags.

Two rules keep these usable when one key holds a large part of all rows:

* reductions are plain aggregates, so a hot key shrinks to one row per task before
  anything is shuffled - there is no window over a whole group;
* joins that bring a table's rows together by key deal the rows of its heavy keys to
  cells, on either side of the join (``spread_join``).

Which keys are heavy is part of the plan; the only job that runs here while a plan is built is
the write of ``row_counts_of``.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import zero_pad
from ..session import written

# A key is heavy if its rows in the result of a join exceed this, and never below this share of
# all rows of that result. The share bounds the number of heavy keys: at most 1 / HEAVY_SHARE
# keys can each hold that much. No cell of a heavy key is expected to hold more.
HEAVY_ROWS = 10_000
HEAVY_SHARE = 1e-5

# Equal rows of a table without a row identity are carried as one row and a number; a number
# above this is carried in several pieces.
EQUAL_ROWS = 1_000

_CELL = "_cell"
_TIMES = "_times"
_PIECE = "_piece"


def _ordered(order: Sequence[str]) -> Column:
    return F.struct(*order)


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    keep: Sequence[str] | None = None,
    last: bool = False,
) -> DataFrame:
    """One row per key: the first in ``order`` (or the last). Rows with a null key go away."""
    rest = [c for c in (keep or df.columns) if c not in keys]
    pick = F.max_by if last else F.min_by
    held = df.dropna(subset=list(keys)).groupBy(*keys).agg(
        pick(F.struct(*rest), _ordered(order)).alias("_row")
    )
    return held.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])


def last_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, keep: Sequence[str] | None = None
) -> DataFrame:
    return first_per_key(df, keys, order, keep=keep, last=True)


def count_per_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_per_key(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """One row per key with the named sums; rows with a null key go away."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()])


def row_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as ``spread_join`` takes them, for several joins of one table."""
    return count_per_key(df, keys, "_rows")


def row_counts_of(df: DataFrame, *key_lists: Sequence[str]) -> list[DataFrame]:
    """``row_counts`` for several keys of one table, in one pass that is written once."""
    columns = list(dict.fromkeys(c for keys in key_lists for c in keys))
    counted = written(df.groupingSets([list(keys) for keys in key_lists], *columns).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows")))

    def own(keys: Sequence[str]) -> DataFrame:
        # A grouping id has a bit for every column that is not part of the set.
        number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        mine = counted.where(F.col("_set") == number).dropna(subset=list(keys))
        return mine.select(*keys, "_rows")

    return [own(keys) for keys in key_lists]


def _cell_side(counts: Sequence[Column], limit: Column) -> Column:
    """Rows of one table that a cell may hold so that the product over all tables, where a
    table cannot give more than it has, comes to ``limit``."""
    by_size = F.array_sort(F.array(*counts))
    sides, used = [], F.lit(1.0)
    for i in range(len(counts)):
        size = F.element_at(by_size, i + 1)
        sides.append((size, F.pow(limit / used, F.lit(1.0 / (len(counts) - i)))))
        used = used * size
    out = sides[-1][1]
    for size, side in reversed(sides[:-1]):
        out = F.when(side <= size, side).otherwise(out)
    return F.greatest(out, F.lit(1.0))


def heavy_keys(counts: DataFrame, keys: Sequence[str], many: Sequence[DataFrame] = ()) -> DataFrame:
    """``keys`` and ``_parts``: into how many parts each table's rows of a heavy key go.

    ``counts`` has the rows per key of the left table, ``many`` those of right tables that
    have several rows per key. The result is part of the plan; it has at most
    ``1 / HEAVY_SHARE`` rows whatever the size of the tables, because every heavy key holds
    at least that share of the joined rows, so it may be broadcast as well.
    """
    joined, names = counts, ["_rows"]
    for i, one in enumerate(many):
        names.append(f"_rows_{i}")
        joined = joined.join(one.withColumnRenamed("_rows", names[-1]), list(keys), "left")
    sizes = [F.coalesce(F.col(n), F.lit(1)).cast("double") for n in names]
    made = joined.select(*keys, *[s.alias(n) for s, n in zip(sizes, names)],
                         reduce(operator.mul, sizes).alias("_made"))
    total = made.agg((F.sum("_made") * F.lit(HEAVY_SHARE)).alias("least")).scalar()
    limit = F.greatest(F.lit(float(HEAVY_ROWS)), total)
    heavy = made.where(F.col("_made") > limit)
    side = _cell_side([F.col(n) for n in names], limit)
    return heavy.select(*keys, F.array(*[F.ceil(F.col(n) / side).cast("int") for n in names])
                        .alias("_parts"))


def collapsed(df: DataFrame) -> DataFrame:
    """Equal rows as one row and ``_times``; many of them in several pieces.

    Which of them is which does not matter, so the pieces are the same in every attempt.
    """
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / EQUAL_ROWS))
    return counted.withColumn(_PIECE, F.explode(pieces)).withColumn(
        _TIMES, F.least(F.lit(EQUAL_ROWS), F.col("_n") - F.col(_PIECE) * EQUAL_ROWS)).drop("_n")


def packed_counts(packed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``row_counts`` of the rows that ``collapsed`` counted, without expanding them."""
    return sum_per_key(packed, keys, {"_rows": F.col(_TIMES)})


def expanded(df: DataFrame, times: Column | str = _TIMES) -> DataFrame:
    """The rows that ``collapsed`` counted, each for itself again."""
    number = F.col(times) if isinstance(times, str) else times
    again = df.withColumn(_TIMES, F.explode(F.sequence(F.lit(1).cast("long"), number)))
    return again.drop(_TIMES, _PIECE)


def spread_join(
    left: DataFrame,
    right: DataFrame | Sequence[DataFrame],
    keys: Sequence[str],
    *,
    many: Sequence[DataFrame] = (),
    rows: Sequence[str] | None = None,
    counts: DataFrame | None = None,
    how: str = "left",
) -> DataFrame:
    """Equi-join on ``keys`` with the rows of every heavy key dealt to cells.

    ``right`` are tables with one row per key, ``many`` tables with any number of them. The
    rows that a heavy key has in the result are cut along every table whose rows are many:
    a row takes its part of its own table by a hash and is repeated for the parts of the
    others, so each combination of rows meets in one cell. All other keys have one cell.
    Left rows with a null key match nothing and are spread freely. All tables share one
    placement of the left rows.

    ``rows`` are columns that tell the rows of ``left`` apart (an ordinal, or all columns of
    a distinct table). Without them equal rows are counted first and travel as pieces, which
    costs another shuffle but splits a million equal rows as well as any others. Tables in
    ``many`` are always counted first. ``counts`` is ``row_counts`` of a table with the same
    keys as ``left``, where that is cheaper to count. Only ``left`` and ``inner`` joins.
    """
    rights = [right] if isinstance(right, DataFrame) else list(right)
    keys, many = list(keys), [one.dropna(subset=keys) for one in many]
    packed = left if rows is not None else collapsed(left)
    heavy = F.broadcast(heavy_keys(
        counts if counts is not None else row_counts(left, keys), keys,
        [row_counts(one, keys) for one in many]))

    def size(i: int) -> Column:
        return F.coalesce(F.col("_parts")[i], F.lit(1))

    def columns(df: DataFrame) -> list[Column]:
        return [F.col(f"`{c}`") for c in df.columns]

    def placed(
        df: DataFrame, own: int | None, names: Sequence[str] = (), blank: Column | None = None
    ) -> DataFrame:
        """Rows with their cells: their own part of table ``own``, all parts of the others.
        A left row with a null key has any cell."""
        out, cell = df.join(heavy, keys, "left"), F.lit(0)
        for i in range(1 + len(many)):
            if i == own:
                row = F.xxhash64(*[F.col(f"`{c}`") for c in names])
                part = F.pmod(row, size(i)).cast("int")
            else:
                part = F.explode(F.sequence(F.lit(0), size(i) - 1))
                if many:
                    out = out.withColumn(f"_part_{i}", part)
                    part = F.col(f"_part_{i}")
            cell = cell * size(i) + part if i else part
        if blank is not None:
            free = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.lit(int(1 / HEAVY_SHARE)))
            cell = F.when(blank, free.cast("int")).otherwise(cell)
        split = [(size(i + 1) > 1).alias(f"_split_{i}") for i in range(len(many))] if own == 0 else []
        return out.select(*columns(df), cell.alias(_CELL), *split)

    blank = reduce(operator.or_, [F.col(f"`{k}`").isNull() for k in keys])
    told = [*rows] if rows is not None else packed.columns
    out = placed(packed, 0, told, blank)
    for one in rights:
        out = out.join(placed(one.dropna(subset=keys), None), [*keys, _CELL], how)
    times = [] if rows is not None else [F.col(_TIMES)]
    for i, one in enumerate(many):
        table = collapsed(one)
        cut = placed(table, i + 1, table.columns).drop(_PIECE)
        out = out.join(cut.withColumnRenamed(_TIMES, f"{_TIMES}_{i}"), [*keys, _CELL], how)
        # A cell of a split key may lack this table's rows; the key has some in other cells.
        out = out.where(~F.col(f"_split_{i}") | F.col(f"{_TIMES}_{i}").isNotNull())
        times.append(F.coalesce(F.col(f"{_TIMES}_{i}"), F.lit(1).cast("long")))
    if times:
        out = expanded(out, reduce(operator.mul, times))
    made = [f"{name}_{i}" for i in range(len(many)) for name in (_TIMES, "_split")]
    return out.drop(_CELL, *made)


def lookup(
    df: DataFrame,
    table: DataFrame | Sequence[DataFrame],
    keys: Sequence[str],
    *,
    rows: Sequence[str] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Left join with tables of one row per key; see ``spread_join``."""
    return spread_join(df, table, keys, rows=rows, counts=counts)


def null_safe_lookup(
    df: DataFrame, table: DataFrame, key: str, *, rows: Sequence[str] | None = None
) -> DataFrame:
    """Left join in which a null key matches a null key.

    The key is first turned into a value that is never null, so heavy keys - the blank one
    among them - are spread like any other.
    """
    safe = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))
    other = [c for c in table.columns if c != key]
    left = df.withColumn("_key", safe)
    return lookup(left, table.select(safe.alias("_key"), *other), ["_key"], rows=rows).drop("_key")


def replace_if_present(
    df: DataFrame, column: str, table: DataFrame, new: str, *, rows: Sequence[str] | None = None
) -> DataFrame:
    """Values of ``column`` that ``table`` knows get its ``new`` value, the others stay."""
    found = lookup(df, table.select(column, F.col(new).alias("_new")), [column], rows=rows)
    return found.withColumn(column, F.coalesce("_new", column)).drop("_new").select(*df.columns)


def membership(
    df: DataFrame, column: str, members: DataFrame, name: str, *,
    rows: Sequence[str] | None = None,
) -> DataFrame:
    """Adds ``name``: true where the value of ``column`` occurs in ``members``."""
    known = members.select(column).distinct().withColumn("_known", F.lit(True))
    return (
        lookup(df, known, [column], rows=rows)
        .withColumn(name, F.coalesce("_known", F.lit(False)))
        .drop("_known")
        .select(*df.columns, name)
    )


def with_key_variants(
    df: DataFrame, key: str, value: str, order: Sequence[str], *, width: int | None = None
) -> DataFrame:
    """``key``, ``key + C1`` and ``key + C2`` each lead to ``value``, one row per key.

    A suffixed spelling wins over a plain one, a later row over an earlier one. With
    ``width`` the keys are zero-padded. Where ``key`` has one row and no width is given,
    ``order`` may be empty: then the aggregate fits fixed-width buffers and needs no sort.
    """
    spelling = F.col("col") if width is None else zero_pad("col", width)
    spelled = df.dropna(subset=[key]).select(
        value, *order, F.posexplode(F.array(*[F.concat(key, F.lit(s)) for s in ("", "C1", "C2")]))
    )
    return spelled.groupBy(spelling.alias(key)).agg(
        F.max_by(value, F.struct("pos", *order) if order else F.col("pos")).alias(value)
    )


def flag_repeats(
    df: DataFrame, column: str, name: str, *, rows: Sequence[str] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Adds ``name``: true on every row whose value of ``column`` occurs more than once.

    The counts name the heavy keys as well, so ``df`` is read twice: to count and to mark.
    """
    counts = counts if counts is not None else row_counts(df, [column])
    repeated = counts.where("_rows > 1").select(column, F.lit(True).alias("_twice"))
    return (
        lookup(df, repeated, [column], rows=rows, counts=counts)
        .withColumn(name, F.coalesce("_twice", F.lit(False)))
        .drop("_twice")
        .select(*df.columns, name)
    )
