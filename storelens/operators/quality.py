"""Constraint checks. Spark enforces no keys, so each check is a job that reports violations.

Keys are counted before they are joined, so a key that holds much of a table shuffles
as one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.sources.schema import declared
from storelens.sources.tables import FAILED_CASTS, FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS, ZERO_ONE_FLAGS


class ForeignKey(NamedTuple):
    """One declared key of a child; a row is right if any of the parents has it."""

    name: str
    columns: tuple[str, ...]
    parents: list[tuple[str, tuple[str, ...]]]


def key_json(columns: Iterable[str]) -> Column:
    """Key values as a JSON object, so that no two keys look alike and NULL is not a text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def duplicate_keys(df: DataFrame, columns: list[str], nulls_allowed: bool = False) -> DataFrame:
    """Key values that occur more than once or have a NULL part (Q1, Q2)."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("QU_ROW"))
    bad = F.col("QU_ROW") > 1
    if not nulls_allowed:
        bad = bad | reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return counted.filter(bad).select(key_json(columns).alias("KEY"), "QU_ROW")


def primary_key_violations(df: DataFrame, table: str) -> DataFrame:
    return duplicate_keys(df, list(PRIMARY_KEYS[table]))


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of the keys and 0/1 checks that the given tables declare, as one report (Q1, Q2, Q4).

    TABLE_NAME, CHECK_NAME, KEY (NULL for a check on values) and QU_ROW. A check whose columns
    a table lacks is listed with a NULL count, for it was not made. Each table is scanned once.
    """
    found = []
    for table, df in tables.items():
        keys, missing = _own_keys(df, table)
        flags = {name: rule for name, rule in flag_checks(table).items() if name.split()[0] in df.columns}
        missing += [name for name in flag_checks(table) if name not in flags]
        found.append(violations(df, keys, flags).select(F.lit(table).alias("TABLE_NAME"), "*"))
        if missing:
            found.append(_listed(df, {"TABLE_NAME": table}, "CHECK_NAME", missing))
    return reduce(DataFrame.unionByName, found)


def full_report(tables: dict[str, DataFrame], parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """All that the given tables declare, as one report: keys, foreign keys, flags, domains (Q1 to Q5).

    Like `constraint_report`. Each table is scanned once for all its checks; parents, which are
    the tables and any further ones, are scanned for their keys.
    """
    known = {**(parents or {}), **tables}
    found = []
    for table, df in tables.items():
        keys, missing = _own_keys(df, table)
        foreign, unknown = _foreign_keys(df, table, known)
        flags = {name: rule for name, rule in flag_checks(table).items() if name.split()[0] in df.columns}
        missing += [name for name in flag_checks(table) if name not in flags] + [key.name for key in unknown]
        rows = violations(df, keys, flags | declared_checks(df, table), foreign, known)
        found.append(rows.select(F.lit(table).alias("TABLE_NAME"), "*"))
        if missing:
            found.append(_listed(df, {"TABLE_NAME": table}, "CHECK_NAME", missing))
    return reduce(DataFrame.unionByName, found)


class Key(NamedTuple):
    """Columns of which no two rows may have equal values."""

    name: str
    columns: tuple[str, ...]
    nulls_allowed: bool


def _own_keys(df: DataFrame, table: str) -> tuple[list[Key], list[str]]:
    """Declared keys of a table, and the names of those that it lacks columns of."""
    named = [Key(f"primary key ({', '.join(PRIMARY_KEYS[table])})", PRIMARY_KEYS[table], False)]
    if table in UNIQUE_KEYS:
        named.append(Key(f"unique key ({', '.join(UNIQUE_KEYS[table])})", UNIQUE_KEYS[table], True))
    made = [key for key in named if set(key.columns) <= set(df.columns)]
    return made, [key.name for key in named if key not in made]


class Slots:
    """Keys of many constraints as rows of one shape: constraint number, numbers, texts.

    Whole numbers, flags and dates take 64-bit slots, all other values text slots, so keys are
    grouped and joined by their values, and mostly by numbers. A slot that a key does not use
    is 0 or empty.
    """

    WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)

    def __init__(self, df: DataFrame, keys: list[tuple[str, ...]]) -> None:
        self.kinds = {f.name: f.dataType for f in df.schema.fields}
        sides = [[self._numeric(c) for c in columns] for columns in keys]
        self.numbers = max((sum(s) for s in sides), default=0)
        self.texts = max((len(s) - sum(s) for s in sides), default=0)
        self.names = ["K", *[f"N{i}" for i in range(self.numbers)], *[f"T{i}" for i in range(self.texts)]]

    def _numeric(self, column: str) -> bool:
        return isinstance(self.kinds[column], (*self.WHOLE, T.DateType))

    def _places(self, columns: tuple[str, ...]) -> dict[str, str]:
        """Slot of each column of a key."""
        places, used = {}, {"N": 0, "T": 0}
        for column in columns:
            side = "N" if self._numeric(column) else "T"
            places[column] = f"{side}{used[side]}"
            used[side] += 1
        return places

    def row(self, number: int, columns: tuple[str, ...] = (), values: Iterable[Column] | None = None) -> Column:
        """The row of a key, of a table's own columns or of values in their types."""
        filled = dict(zip(self._places(columns).items(), values or [F.col(f"`{c}`") for c in columns]))
        slots = {}
        for (column, place), value in filled.items():
            if isinstance(self.kinds[column], T.DateType):
                value = F.unix_date(value)
            slots[place] = value.cast("bigint" if place[0] == "N" else "string")
        unused = {"N": F.lit(0).cast("bigint"), "T": F.lit("")}
        return F.struct(F.lit(number).alias("K"), *[slots.get(n, unused[n[0]]).alias(n) for n in self.names[1:]])

    def json(self, columns: tuple[str, ...]) -> Column:
        """The key of a row as JSON, its values in the types of the table."""
        parts = []
        for column, place in self._places(columns).items():
            kind, value = self.kinds[column], F.col(place)
            value = F.date_from_unix_date(value.cast("int")) if isinstance(kind, T.DateType) else value.cast(kind)
            parts.append(value.alias(column))
        return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})

    def missing(self, columns: tuple[str, ...]) -> Column:
        """Whether a key of a row has a NULL part."""
        return reduce(lambda a, b: a | b, [F.col(place).isNull() for place in self._places(columns).values()])


def _complete(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def _as_child(column: Column, parent: T.DataType, child: T.DataType) -> Column:
    """A parent's value in the type of the child, or NULL if no child can equal it."""
    if parent == child:
        return column
    value = column.try_cast(child)
    # A number must not become another one, as 1.5 would as a whole number.
    exact = isinstance(parent, T.NumericType) and isinstance(child, T.NumericType)
    return F.when(value.try_cast(parent) == column, value) if exact else value


def violations(
    df: DataFrame,
    keys: list[Key],
    checks: dict[str, Column],
    foreign: list[ForeignKey] | None = None,
    tables: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """CHECK_NAME, KEY, QU_ROW of all violated constraints of a table, by one scan and one aggregate.

    A row of the table becomes a row for each of its keys and for each check that it fails.
    These are counted before they move and then once more; only what violates a constraint gets
    a text. Foreign keys with a NULL part are not checked.
    """
    foreign = foreign or []
    slots = Slots(df, [k.columns for k in [*keys, *foreign]])
    names = [k.name for k in [*keys, *foreign]] + list(checks)
    if not names:
        return _listed(df, {}, "CHECK_NAME", [""]).filter("false")
    met = [slots.row(i, key.columns) for i, key in enumerate(keys)]
    met += [
        F.when(_complete(F.col(f"`{c}`") for c in key.columns), slots.row(i, key.columns))
        for i, key in enumerate(foreign, len(keys))
    ]
    if checks:
        # Few rows fail a check, so only those make rows for them.
        failed = F.array(*[F.when(check, slots.row(i)) for i, check in enumerate(checks.values(), len(met))])
        fails = reduce(lambda a, b: a | b, checks.values())
        of_keys = F.array(*met) if met else F.filter(failed, lambda x: F.lit(False))
        every = F.when(fails, F.concat(of_keys, failed) if met else failed).otherwise(of_keys)
    else:
        every = F.array(*met)
    # NULL rows go after the explosion, which stays in generated code.
    exploded = df.select(F.explode(every).alias("P")).filter(F.col("P").isNotNull()).select("P.*")
    counted = exploded.groupBy(*slots.names).agg(F.count(F.lit(1)).alias("QU_ROW"))
    bad = F.col("K") >= len(keys)
    for i, key in enumerate(keys):
        several = F.col("QU_ROW") > 1
        bad = bad | ((F.col("K") == i) & (several if key.nulls_allowed else several | slots.missing(key.columns)))
    counted = counted.filter(bad)
    if foreign:
        counted = counted.join(_parent_rows(foreign, len(keys), slots, tables), slots.names, "left_anti")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("K") + 1)
    text = F.lit(None).cast("string")
    for i, key in enumerate([*keys, *foreign]):
        text = F.when(F.col("K") == i, slots.json(key.columns)).otherwise(text)
    return counted.select(name.alias("CHECK_NAME"), text.alias("KEY"), "QU_ROW")


def _parent_rows(foreign: list[ForeignKey], first: int, slots: Slots, tables: dict[str, DataFrame]) -> DataFrame:
    """The keys of the parents, in the types of the child; a parent is scanned once for all keys to it."""
    wanted: dict[tuple[str, tuple[str, ...]], list[Column]] = {}
    for i, key in enumerate(foreign, first):
        for parent, columns in key.parents:
            kinds = {f.name: f.dataType for f in tables[parent].schema.fields}
            values = [_as_child(F.col(p), kinds[p], slots.kinds[c]) for p, c in zip(columns, key.columns)]
            wanted.setdefault((parent, columns), []).append(F.when(_complete(values), slots.row(i, key.columns, values)))
    known = [
        tables[parent].select(F.explode(F.array(*rows)).alias("P")).filter(F.col("P").isNotNull()).select("P.*")
        for (parent, _), rows in wanted.items()
    ]
    return reduce(DataFrame.unionByName, known)


def _listed(df: DataFrame, fixed: dict[str, str], column: str, names: list[str]) -> DataFrame:
    """A row for each name, with KEY and QU_ROW NULL."""
    rows = df.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias(column))
    return rows.select(
        *[F.lit(v).alias(k) for k, v in fixed.items()],
        column,
        F.lit(None).cast("string").alias("KEY"),
        F.lit(None).cast("bigint").alias("QU_ROW"),
    )


def declared_foreign_keys(child: str) -> list[ForeignKey]:
    targets: dict[tuple[str, ...], list[tuple[str, tuple[str, ...]]]] = {}
    for table, columns, parent, keys in FOREIGN_KEYS:
        if table == child:
            targets.setdefault(columns, []).append((parent, keys))
    return [
        ForeignKey(f"{child}({','.join(columns)}) -> {'|'.join(p for p, _ in parents)}", columns, parents)
        for columns, parents in targets.items()
    ]


def orphans(child: DataFrame, keys: list[ForeignKey], tables: dict[str, DataFrame]) -> DataFrame:
    """CONSTRAINT_NAME, KEY, QU_ROW of key values that no parent has (Q3); one scan of the child.

    Parents are compared by value in the child's type; one that has no value there, such as a
    text for a whole number, is no parent of any row.
    """
    return violations(child, [], {}, keys, tables).withColumnRenamed("CHECK_NAME", "CONSTRAINT_NAME")


def _foreign_keys(df: DataFrame, child: str, tables: dict[str, DataFrame]) -> tuple[list[ForeignKey], list[ForeignKey]]:
    """Declared foreign keys of a table that can be checked, and those that cannot."""
    checked, skipped = [], []
    for key in declared_foreign_keys(child):
        given = all(parent in tables and set(columns) <= set(tables[parent].columns) for parent, columns in key.parents)
        (checked if given and set(key.columns) <= set(df.columns) else skipped).append(key)
    return checked, skipped


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared foreign key of the given tables, as one report (Q3).

    Bridge tables declare one key to three facts; such a row is right if any of them has it.
    A key that cannot be checked, because a parent or a column is not given, is listed with
    NULL as its KEY and QU_ROW.
    """
    reports = []
    for child, df in tables.items():
        checked, skipped = _foreign_keys(df, child, tables)
        if checked:
            reports.append(orphans(df, checked, tables))
        if skipped:
            reports.append(_listed(df, {}, "CONSTRAINT_NAME", [key.name for key in skipped]))
    if not reports:
        raise ValueError("the given tables declare no foreign key")
    return reduce(DataFrame.unionByName, reports)


def not_zero_one(column: str) -> Column:
    """A NULL flag passes the check."""
    return F.col(column).isNotNull() & ~F.col(column).isin(0, 1)


def too_long(column: str, length: int) -> Column:
    return F.length(F.col(column)) > length


def overflows(column: str, precision: int, scale: int) -> Column:
    """The value, rounded to the scale, has more whole digits than a declared decimal."""
    limit = F.lit("1" + "0" * (precision - scale)).cast(f"decimal({precision - scale + 1},0)")
    return F.abs(F.round(F.col(column), scale)) >= limit


def failing_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that fail any check, with the names of the failed ones (Q4, Q5); one pass for all."""
    names = [F.when(condition, F.lit(name)) for name, condition in checks.items()]
    failing = df.filter(reduce(lambda a, b: a | b, checks.values()))
    return failing.withColumn("FAILED", F.concat_ws("; ", *names))


def failure_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Failing rows per check; one aggregate over the table, no row per failure."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    rows = [
        F.struct(F.lit(name).alias("CHECK_NAME"), F.col(f"`{name}`").alias("QU_ROW")) for name in checks
    ]
    return counted.select(F.inline(F.array(*rows))).filter(F.col("QU_ROW") > 0)


def flag_checks(table: str) -> dict[str, Column]:
    """The declared 0/1 checks of a table."""
    return {f"{flag} in (0,1)": not_zero_one(flag) for flag in ZERO_ONE_FLAGS.get(table, ())}


def not_null_checks(columns: list[str]) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNull() for c in columns}


def declared_checks(df: DataFrame, table: str) -> dict[str, Column]:
    """NOT NULL, text length and value range of the columns of a typed scan (Q5), in declared order.

    A value that its type cannot hold is reported as such, and not as NULL.
    """
    none = F.array().cast("array<string>")
    failed = F.coalesce(F.map_keys(FAILED_CASTS), none) if FAILED_CASTS in df.columns else none
    checks = {}
    for rule in declared(table).values():
        if rule.name not in df.columns:
            continue
        lost = F.array_contains(failed, rule.name)
        if rule.required:
            checks[f"{rule.name} not null"] = F.col(rule.name).isNull() & ~lost
        if rule.length is not None:
            checks[f"{rule.name} {rule.type}"] = F.coalesce(too_long(rule.name, rule.length), F.lit(False))
        else:
            checks[f"{rule.name} {rule.type}"] = lost
    return checks
