"""What a subject area declares, and the warehouse that builds it."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from contextvars import ContextVar
from dataclasses import dataclass, field
from threading import RLock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.scoring import band, score
from lamina.operators.keys import ROW, dense_key
from lamina.operators.lookups import lookup
from lamina.operators.metrics import activity
from lamina.operators.parallel import side_by_side
from lamina.operators.staging import let_go, noting_staged, release, stage
from lamina.sources.schemas import conform, table_schema

# The constants of one build run.
REPORT_DATE = "2024-12-31"
CALCULATED = {
    "hr.fct_employee_hr_snapshot": "2024-12-31 23:00:00",
    "risk.fct_employee_risk_factor": "2024-12-31 23:00:00",
    "risk.fct_employee_risk_snapshot": "2024-12-31 23:30:00",
    "access.fct_employee_access_snapshot": "2024-12-31 23:10:00",
    "finance.fct_employee_finance_snapshot": "2024-12-31 23:20:00",
}
BATCHES = {
    "hr": "hr_dds_build_001",
    "risk": "risk_dds_build_001",
    "access": "access_dds_build_001",
    "finance": "finance_dds_build_001",
}


@dataclass(frozen=True)
class Run:
    """Report date, calculation times and batch ids of one build."""

    report_date: str = REPORT_DATE
    calculated: Mapping[str, str] = field(default_factory=lambda: CALCULATED)
    batches: Mapping[str, str] = field(default_factory=lambda: BATCHES)

    def stamp(self, df: DataFrame, table: str) -> DataFrame:
        """Add the run's columns to the rows of a calculated table."""
        moment = f"timestamp_ntz'{self.calculated[table]}'"
        return df.selectExpr(
            "*",
            f"date'{self.report_date}' as report_date",
            f"{moment} as calculation_dttm",
            f"{moment} as load_dttm",
            f"'{self.batches[table.split('.')[0]]}' as batch_id",
        )


@dataclass(frozen=True)
class Lookup:
    """A foreign key: which table resolves it, on what, and what it adds."""

    table: str
    on: Mapping[str, str]
    take: Mapping[str, str]
    current: bool = False
    orphans: str = "keep"


@dataclass(frozen=True)
class Scoring:
    """Weights, divisors and bands of one subject's score."""

    value: str
    level: str
    weights: Mapping[str, str]
    floors: tuple[tuple[str, str], ...]
    divisors: Mapping[str, str] = field(default_factory=dict)
    otherwise: str = "LOW"

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the unrounded score and the level it reaches."""
        scored = df.withColumn(self.value, score(self.weights, self.divisors))
        return scored.withColumn(self.level, band(F.col(self.value), self.floors, self.otherwise))


@dataclass(frozen=True)
class Table:
    """A detail table: its rows, the surrogate key over them, and a step that needs the key.

    ``order`` may go on past the natural key with a few columns that tell apart records
    sharing one, such as the versions of a department or two payments under one number.
    ``optional`` names foreign keys that the layout requires and that orphans, which are kept,
    leave NULL.
    """

    rows: Callable[[Warehouse], DataFrame]
    key: str
    order: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame] | None = None
    optional: tuple[str, ...] = ()


Build = Callable[["Warehouse"], DataFrame]
Store = Callable[[str, DataFrame], DataFrame]


class Warehouse:
    """Builds tables on demand from raw tables, each once.

    ``raw`` gives a stored raw table by name. ``rows`` gives a table without paying for its
    surrogate key; ``table`` gives it keyed and in its stored layout. ``activity`` gives what one
    pass over an event table says of each entity, for every step that needs a part of it. With
    ``store``, every table and activity is handed to it when built, and later steps read what it
    returns; what was staged for it is deleted then.
    """

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        tables: Mapping[str, Table],
        reports: Mapping[str, Build],
        run: Run | None = None,
        store: Store | None = None,
        activities: Mapping[str, Build] | None = None,
    ) -> None:
        self.raw = raw
        self.run = run or Run()
        self._plans = tables
        self._reports = reports
        self._store = store
        self._rows: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}
        # Rows of the tables keyed so far.
        self._counts: dict[str, int] = {}
        self._activities = activities or {}
        self._locks = {name: RLock() for name in (*tables, *self._activities)}
        # The columns that this thread's plan has to give; None for all.
        self._needed: ContextVar[frozenset[str] | None] = ContextVar("needed", default=None)

    def adopt(self, name: str, stored: DataFrame) -> None:
        """Read a table from where it has been written instead of building it."""
        self._tables[name] = stored

    def rows(self, name: str) -> DataFrame:
        if self._store is not None or name in self._tables:
            return self.table(name)
        return self._unkeyed(name)

    def part(self, name: str, columns: Iterable[str]) -> DataFrame:
        """Some columns of a table, every row of it.

        A foreign key that is not among them stays unresolved, and the table it refers to needs no
        surrogate key then: it is joined only for how often it holds a value, which Spark leaves out
        where that is once.
        """
        wanted = frozenset(columns)
        if self._store is not None or name in self._tables:
            return self.table(name).select(*sorted(wanted))
        before = self._needed.set(wanted)
        try:
            built = self._plans[name].rows(self)
        finally:
            self._needed.reset(before)
        return conform(built, T.StructType([f for f in table_schema(name) if f.name in wanted]))

    def measured(self, name: str, entity: str, measures: Mapping[str, str]) -> DataFrame:
        """``activity`` of a table's rows, of which only the columns that the measures name are built."""
        words = set(re.findall(r"\w+", " ".join(measures.values())))
        return activity(self.part(name, {entity, *words.intersection(table_schema(name).names)}), entity, measures)

    def _unkeyed(self, name: str) -> DataFrame:
        if name not in self._rows:
            plan = self._plans[name]
            before = self._needed.set(None)
            try:
                built = plan.rows(self)
            finally:
                self._needed.reset(before)
            columns = built.columns
            stored = T.StructType(
                [f for f in table_schema(name) if f.name in columns and f.name != plan.key]
            )
            order_only = set(columns).intersection((*plan.order, ROW)).difference(stored.names)
            self._rows[name] = conform(built, stored, helpers=sorted(order_only))
        return self._rows[name]

    def table(self, name: str, pinned: bool = True) -> DataFrame:
        """The keyed table. One that is read once, as a result, need not be ``pinned``."""
        with self._locks[name]:
            if name not in self._tables:
                pinned = pinned and self._store is None
                self._tables[name] = self._stored(name, lambda: self._keyed(name, pinned))
            return self._tables[name]

    def activity(self, name: str, pinned: bool = False) -> DataFrame:
        """One row per entity with all its measures of an event table, computed once.

        A warehouse without ``store`` plans it anew for every reader, unless one asks for it
        ``pinned``, before the others: then all read what that one stages.
        """
        with self._locks[name]:
            if name in self._tables:
                return self._tables[name]
            if self._store is None and not pinned:
                return self._activities[name](self)
            kept = (lambda df: stage(df, "activity")) if self._store is None else (lambda df: df)
            self._tables[name] = self._stored(name, lambda: kept(self._activities[name](self)))
            return self._tables[name]

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table that ``build`` gives, handed to ``store`` if there is one."""
        if self._store is None:
            return build()
        with noting_staged() as paths:
            built = build()
            stored = self._store(name, built)
        spark = built.sparkSession
        release(spark, paths)
        # Whoever needs the rows again reads the stored table.
        self._rows.pop(name, None)
        del built
        let_go(spark)
        return stored

    def _keyed(self, name: str, pinned: bool) -> DataFrame:
        plan = self._plans[name]
        rows = self._unkeyed(name)
        columns = rows.columns
        stored = [c for c in table_schema(name).names if c in columns]
        # A step after the key may read the rows more than once.
        keyed = dense_key(
            rows,
            plan.key,
            plan.order,
            keep=stored,
            pinned=pinned or plan.finish is not None,
            counted=lambda n: self._counts.update({name: n}),
        )
        if plan.finish is not None:
            keyed = plan.finish(keyed)
        return conform(keyed, table_schema(name))

    def ensure(self, names: Iterable[str]) -> None:
        """Build the named tables, side by side where several are missing.

        A table waits for what it needs through the lock of that table, so shared dimensions
        are still built once.
        """
        side_by_side(self.table, [n for n in dict.fromkeys(names) if n not in self._tables])

    def report(self, name: str) -> DataFrame:
        """A mart or view in its published layout."""
        return conform(self._reports[name](self), table_schema(name))

    def resolve(self, df: DataFrame, *lookups: Lookup) -> DataFrame:
        needed = self._needed.get()
        on_keys = {left for step in lookups for left in step.on}

        def idle(step: Lookup) -> bool:
            """Whether nothing that the step takes is used, by a later step or the result."""
            used = needed is None or not (needed | on_keys).isdisjoint(step.take)
            return not used and step.orphans == "keep"

        self.ensure(step.table for step in lookups if not idle(step))
        for step in lookups:
            if idle(step):
                flag = ["is_current_flag"] if step.current else []
                df = lookup(df, self.part(step.table, [*step.on.values(), *flag]), step.on, {}, step.current)
            else:
                dim, rows = self.table(step.table), self._counts.get(step.table)
                df = lookup(df, dim, step.on, step.take, step.current, step.orphans, rows)
        return df
