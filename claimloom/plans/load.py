"""The load: dimensions, facts and audit tables, made visible together at the end of a run.

Each procedure works on a run and leaves its tables as the next one reads them. ``publish`` chains any
of them into one run with one manifest: a procedure that fails publishes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import fixed_values as fv
from claimloom import schemas
from claimloom.operators.dimensions import (
    key_of,
    load_dim_date,
    load_dim_diagnosis,
    load_dim_plan,
    load_dim_procedure,
    seed_unknown,
)
from claimloom.operators.facts import (
    advance_watermark,
    claim_dead_letters,
    claim_facts,
    dead_letters,
    line_facts,
    line_watermark,
    replace_line_letters,
    resolve_claims,
    resolve_lines,
    retained_dead_letters,
)
from claimloom.operators.gate import BREACHES, SOURCE_RULES, Gate
from claimloom.operators.keys import assign_keys_by_file, next_key
from claimloom.operators.scd2 import check_versions, member_changes, provider_changes, scd2_merge
from claimloom.plans.summary import monthly_claim_volume
from claimloom.session import CODEC, together
from claimloom.sources.fixture import load_profile
from claimloom.sources.store import Run, TableStore

DIMENSIONS = ["dim_date", "dim_plan", "dim_diagnosis", "dim_procedure", "dim_member", "dim_provider"]

# The source tables behind each dimension; all rows of them are checked, as all are merged.
BEHIND = {
    "dim_date": [],
    "dim_plan": ["plan_types"],
    "dim_diagnosis": ["diagnosis_codes"],
    "dim_procedure": ["procedure_codes"],
    "dim_member": ["members", "member_plan_history"],
    "dim_provider": ["providers", "provider_network_history"],
}
LOAD = [*DIMENSIONS, "fact_claim", "fact_claim_line", "load_profile"]
SUMMARY = "monthly_claim_volume"
RESET = "reset"


@dataclass(frozen=True)
class Counts:
    """Rows of a fact's batch that were added, and that became dead letters."""

    inserted: int
    rejected: int


@dataclass
class LoadReport:
    """The published version and what each fact load did."""

    version: int
    facts: dict[str, Counts]


@dataclass
class Load:
    """One run's procedures over one source."""

    run: Run
    source: dict[str, DataFrame]
    calendar: tuple[str | date, str | date]
    now: datetime
    gate: Gate
    counts: dict[str, Counts] = field(default_factory=dict)
    letters_before: DataFrame | None = None

    def do(self, names: list[str]) -> None:
        """The named procedures in the order of a load; dimensions side by side."""
        if RESET in names:
            self._side_by_side(self._seed, DIMENSIONS)
        dimensions = [name for name in DIMENSIONS if name in names]
        self.gate.check_whole(self.source, [table for name in dimensions for table in BEHIND[name]])
        if "fact_claim_line" in names:  # not among the default rules
            self.gate.check_parents(self.source, "claim_lines")
        chains = [[name] for name in dimensions if name not in ("dim_plan", "dim_member")]
        chains.append([name for name in ("dim_plan", "dim_member") if name in dimensions])  # members name plans by their key
        self._side_by_side(lambda chain: [getattr(self, name)() for name in chain], [chain for chain in chains if chain])
        for name in ("fact_claim", "fact_claim_line", "load_profile", SUMMARY):
            if name in names:
                getattr(self, name)()

    def _side_by_side(self, procedure: Callable, items: list) -> None:
        if items:
            together(self.run.store.spark, *[partial(procedure, item) for item in items])

    def _seed(self, table: str) -> None:
        self.run.replace(table, seed_unknown(schemas.empty(self.run.store.spark, table), table))

    def _stage(self, name: str, rows: DataFrame, split: str) -> DataFrame:
        """Write resolved rows once, in a folder for each value of the boolean column ``split``.

        Everything after reads the written rows: the joins behind them run once, and a lost executor
        costs a re-read instead of a recomputation.
        """
        folder = f"{self.run.folder}/{name}"
        rows.write.partitionBy(split).parquet(folder, compression=CODEC)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return self.run.store.spark.read.schema(columns).parquet(folder)

    # dimensions

    def dim_date(self) -> None:
        self.run.replace("dim_date", load_dim_date(self.run.read("dim_date"), *self.calendar).coalesce(1))

    def dim_plan(self) -> None:
        self.run.replace("dim_plan", load_dim_plan(self.run.read("dim_plan"), self.source["plan_types"]))

    def dim_diagnosis(self) -> None:
        self.run.replace("dim_diagnosis", load_dim_diagnosis(self.run.read("dim_diagnosis"), self.source["diagnosis_codes"]))

    def dim_procedure(self) -> None:
        self.run.replace("dim_procedure", load_dim_procedure(self.run.read("dim_procedure"), self.source["procedure_codes"]))

    def dim_member(self) -> None:
        history, plans = self.source["member_plan_history"], self.run.read("dim_plan")
        self._versions("dim_member", "member_id", member_changes(self.run.read("dim_member"), history, self.source["members"], plans))

    def dim_provider(self) -> None:
        history = self.source["provider_network_history"]
        self._versions("dim_provider", "provider_id", provider_changes(self.run.read("dim_provider"), history, self.source["providers"]))

    def _versions(self, table: str, key: str, changes: DataFrame) -> None:
        """The folded history is written once; closing, numbering and adding all read it back."""
        dim, surrogate = self.run.read(table), key_of(table)
        staged = self._stage(f"{table}_changes", changes, "is_new")
        keyed = assign_keys_by_file(staged.filter("is_new"), surrogate, next_key(dim, surrogate))
        check_versions(self.run.replace(table, scd2_merge(dim, table, key, staged, keyed)), table, key)

    # facts

    def _batch(self, name: str, table: str, resolved: DataFrame, fact: DataFrame) -> DataFrame:
        """The unloaded rows of a source table, written and checked."""
        batch = self._stage(name, resolved.withColumn("accepted", F.col("reject_reason").isNull()), "accepted")
        self.gate.check_batch(batch, table, self.source[table], fact)
        found = {row.accepted: row["count"] for row in batch.groupBy("accepted").count().collect()}
        self.counts["fact_claim" if table == "claims" else "fact_claim_line"] = Counts(found.get(True, 0), found.get(False, 0))
        return batch

    def fact_claim(self) -> None:
        """Header fact with its dead letters and mark."""
        run = self.run
        fact, letters, marks = (run.read(t) for t in ("fact_claim", "etl_dead_letter", "etl_watermark"))
        claims = self.gate.marked(self.source["claims"], "claims")
        dims = {table: run.read(table) for table in DIMENSIONS}
        resolved = resolve_claims(claims, self.source["claim_lines"], dims, fact, (BREACHES,))
        batch = self._batch("claim_load_batch", "claims", resolved, fact)
        accepted = assign_keys_by_file(batch.filter("accepted"), "claim_key", next_key(fact, "claim_key"))
        rejected = assign_keys_by_file(batch.filter("not accepted"), "dead_letter_id", next_key(letters, "dead_letter_id"))
        remaining = retained_dead_letters(letters, batch).unionByName(claim_dead_letters(rejected, self.now))
        self.letters_before = letters
        together(
            run.store.spark,
            lambda: run.append("fact_claim", claim_facts(accepted, self.now)),
            lambda: run.replace("etl_dead_letter", remaining),
            lambda: run.replace("etl_watermark", advance_watermark(marks, batch, self.now).coalesce(1)),
        )

    def fact_claim_line(self) -> None:
        """Line fact, then its dead letters and mark."""
        run = self.run
        fact_claim, fact_line, letters, marks = (
            run.read(t) for t in ("fact_claim", "fact_claim_line", "etl_dead_letter", "etl_watermark")
        )
        lines = self.gate.marked(self.source["claim_lines"], "claim_lines")
        dims = {table: run.read(table) for table in ("dim_date", "dim_procedure", "dim_diagnosis")}
        resolved = resolve_lines(lines, dims, fact_claim, fact_line, letters).drop("diagnosis_code", "service_date", "_header_reason")
        batch = self._batch("line_load_batch", "claim_lines", resolved, fact_line)
        accepted, rejected = batch.filter("accepted"), batch.filter("not accepted")
        numbered = assign_keys_by_file(accepted, "claim_line_key", next_key(fact_line, "claim_line_key"))
        # letter numbers go on behind this run's claim letters and all earlier ones
        earlier = letters if self.letters_before is None else self.letters_before
        last = F.greatest(next_key(letters, "dead_letter_id"), next_key(earlier, "dead_letter_id"))
        line_letters = dead_letters(
            assign_keys_by_file(rejected, "dead_letter_id", last),
            fv.LINE_PIPELINE, fv.LINE_SOURCE, "claim_line_id", self.now, fv.REASON_LENGTH,
        )
        together(
            run.store.spark,
            lambda: run.append("fact_claim_line", line_facts(numbered, self.now)),
            lambda: run.replace("etl_dead_letter", replace_line_letters(letters, line_letters)),
            lambda: run.replace("etl_watermark", line_watermark(marks, accepted, self.now).coalesce(1)),
        )

    def load_profile(self) -> None:
        """The one-row record of the source volumes."""
        self.run.replace("load_profile", load_profile(self.source, None, self.now).coalesce(1))

    def monthly_claim_volume(self) -> None:
        """The summary of the fact as this run has it."""
        fact = {name: self.run.read(name) for name in ("fact_claim", "dim_date")}
        self.run.replace(SUMMARY, monthly_claim_volume(fact).coalesce(1))


def publish(
    store: TableStore,
    source: dict[str, DataFrame],
    procedures: list[str],
    calendar: tuple[str | date, str | date] = (fv.CALENDAR_START, fv.CALENDAR_END),
    now: datetime | None = None,
    rules: list[tuple[str, str | None]] = SOURCE_RULES,
    checks: dict[str, dict[str, str]] = schemas.CHECKS,
) -> LoadReport:
    """Run procedures, named by their table, in one run and publish it. ``now`` stamps all its rows.

    ``reset`` empties the warehouse first. The source must keep the declared constraints named by
    ``rules``, pairs of a kind and a table (None: every table), with the checks as given: a repeated key
    would double facts, and a version of an unknown plan or entity would close its predecessor and
    then vanish. A failed check raises before the manifest is written, so the published state stays
    as it was.
    """
    unknown = set(procedures) - {*LOAD, SUMMARY, RESET}
    if unknown:
        raise ValueError(f"no such procedure: {sorted(unknown)}")
    load = Load(store.begin(reset=RESET in procedures), source, calendar, now or datetime.now(), Gate(rules, checks))
    load.do(procedures)
    return LoadReport(load.run.publish(), load.counts)


def reset_warehouse(store: TableStore) -> int:
    """Publish an empty warehouse that holds only the placeholder rows. Old folders stay on disk."""
    return publish(store, {}, [RESET]).version


def run_etl(store: TableStore, source: dict[str, DataFrame], *args, **options) -> LoadReport:
    """Load every source table and publish the new version; takes the options of ``publish``."""
    return publish(store, source, LOAD, *args, **options)
