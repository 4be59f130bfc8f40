"""Refresh runs: which reports are due, in what order, and how they are written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from reqmart.functions import fixed_values as fixed
from reqmart.operators.aggregates import with_audit_column
from reqmart.operators.keys import new_keys, restrict
from reqmart.plans import claims, cogs, dates, gpi, ledger as ledgers, model, mshare, shifted
from reqmart.session import materialise, run
from reqmart.sources.store import ReportStore

LEDGER, PARAMS, DATES, SHARES = "process_time", "request_params", "dates_dim", "market_share"


@dataclass
class RefreshInputs:
    """What a run reads. Reports whose inputs are absent are not made."""

    history: DataFrame
    log: DataFrame
    params: DataFrame
    request_type: str
    facts: DataFrame | None = None
    formulary_list: DataFrame | None = None
    network: DataFrame | None = None
    formulary: DataFrame | None = None
    specialty_master: DataFrame | None = None
    drug_master: DataFrame | None = None
    models: DataFrame | None = None
    claims_tags: DataFrame | None = None
    claims_preshift: DataFrame | None = None
    formulary_shifted: DataFrame | None = None
    house_shifted: DataFrame | None = None
    dispensed_shifted: DataFrame | None = None
    market_shifted: DataFrame | None = None
    generic_launches: DataFrame | None = None
    specialty_label: str = "Specialty"
    clock_from: str = fixed.CLOCK_TEXT_FROM
    drug_mix_since: str = fixed.DRUG_MIX_SINCE
    _tagged: dict[int, DataFrame] = field(default_factory=dict, init=False, repr=False)

    def claims_of(self, delta: DataFrame) -> DataFrame:
        """Tagged claims of the delta's requests, computed once in a run for the four reports made of them."""
        if id(delta) not in self._tagged:
            self._tagged[id(delta)] = materialise(claims.claims_base(self.claims_tags, self.claims_preshift, delta))
        return self._tagged[id(delta)]


@dataclass
class Report:
    """A report made for new requests: its table, inputs, rows for given keys, and layout."""

    name: str
    needs: list[str]
    build: Callable[[RefreshInputs, DataFrame], DataFrame]
    keys: tuple[str, ...] = tuple(fixed.REPORT_KEYS)
    partition_by: tuple[str, ...] = tuple(fixed.REPORT_KEYS)


@dataclass
class ModelReport:
    """A report made for new scenarios from a base report."""

    name: str
    base: str
    build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]
    match_guids: bool


@dataclass
class RefreshResult:
    """What a run did: tables written, and the reconciliation row (none if nothing was due)."""

    written: list[str]
    reconciliation: DataFrame | None = None


LOOKUPS = ["facts", "formulary_list", "network", "formulary", "specialty_master"]


def _of_requests(df: DataFrame, delta: DataFrame) -> DataFrame:
    return restrict(df, delta, dict(zip(fixed.REPORT_KEYS, fixed.LEDGER_KEYS)))


def _strategy(i: RefreshInputs, delta: DataFrame) -> DataFrame:
    preshift = restrict(i.claims_preshift, delta, dict(zip(fixed.REQUEST_KEYS, fixed.LEDGER_KEYS)))
    facts = (i.formulary_shifted, i.house_shifted, i.dispensed_shifted, i.market_shifted)
    modules = shifted.shift_modules(preshift, *(_of_requests(f, delta) for f in facts))
    return shifted.shift_strategy(modules, i.specialty_label)


CLAIMS = ["claims_tags", "claims_preshift"]
SHIFTED = ["formulary_shifted", "house_shifted", "dispensed_shifted", "market_shifted"]

REPORTS = [
    Report("claims_top_drugs", CLAIMS, lambda i, d: claims.top_drugs(i.claims_of(d))),
    Report("claims_states", CLAIMS, lambda i, d: claims.state_counts(i.claims_of(d))),
    Report("claims_preshift", CLAIMS, lambda i, d: claims.preshift_monthly(i.claims_of(d))),
    Report("claims_summary", CLAIMS, lambda i, d: claims.summary_metrics(i.claims_of(d))),
    Report(
        "formulary_shifted", SHIFTED[:1],
        lambda i, d: shifted.shifted_by_flag(_of_requests(i.formulary_shifted, d), "origclaim"),
    ),
    Report(
        "formulary_shifted_excl", SHIFTED[:1],
        lambda i, d: shifted.shifted_excluding(_of_requests(i.formulary_shifted, d)),
    ),
    Report(
        "house_shifted", SHIFTED[1:2],
        lambda i, d: shifted.shifted_by_flag(_of_requests(i.house_shifted, d), "hg_origclaim", "hgorigclaim"),
    ),
    Report(
        "dispensed_shifted", SHIFTED[2:3],
        lambda i, d: shifted.shifted_single_pass(_of_requests(i.dispensed_shifted, d), "daw9_origclaim"),
    ),
    Report(
        "market_shifted", SHIFTED[3:],
        lambda i, d: shifted.shifted_by_flag(
            _of_requests(i.market_shifted, d), "daw9_origclaim", "pcsk9_origclaim", "origclaim"
        ),
    ),
    Report(
        "generic_launches", ["generic_launches"],
        lambda i, d: shifted.generic_launches(_of_requests(i.generic_launches, d)),
    ),
    Report(
        "shift_strategy", [*CLAIMS[1:], *SHIFTED], _strategy,
        tuple(fixed.REQUEST_KEYS), tuple(fixed.REQUEST_KEYS),
    ),
    Report(
        "cogs", LOOKUPS,
        lambda i, d: cogs.cogs_report(
            i.facts, d, i.params, i.formulary_list, i.network, i.formulary, i.specialty_master
        ),
    ),
    Report(
        "gpi", [*LOOKUPS, "drug_master"],
        lambda i, d: gpi.gpi_report(
            i.facts, d, i.params, i.formulary_list, i.network, i.formulary, i.specialty_master,
            i.drug_master, i.drug_mix_since,
        ),
        partition_by=("opportunity_id", *fixed.REPORT_KEYS),
    ),
]
MODEL_REPORTS = [
    ModelReport("cogs_model", "cogs", model.cogs_model, True),
    ModelReport("gpi_model", "gpi", model.gpi_model, False),
]


def _due(inputs: RefreshInputs) -> tuple[list[Report], list[ModelReport]]:
    reports = [r for r in REPORTS if all(getattr(inputs, n) is not None for n in r.needs)]
    bases = {r.name for r in reports}
    models = [m for m in MODEL_REPORTS if inputs.models is not None and m.base in bases]
    return reports, models


def _scenarios(store: ReportStore, inputs: RefreshInputs, report: ModelReport) -> DataFrame:
    """Keys of the scenarios that are due. The base report is read only if some were not seen yet."""
    known, base = store.read_if_exists(report.name), store.read_if_exists(report.base)
    unseen = materialise(model.unseen_scenarios(inputs.models, known))
    if known is None or base is None or unseen.isEmpty():
        return unseen
    return materialise(model.matching_scenarios(inputs.models, unseen, base, report.match_guids))


def refresh(store: ReportStore, inputs: RefreshInputs, replace: bool = True) -> RefreshResult:
    """Bring all reports up to date with the requests and scenarios that are new.

    A report is due if its table is absent, then for every request, or if there are new requests,
    then for those. The ledger is stored last, so a run that fails is repeated by the next one.
    ``replace`` makes that safe: rows of the same keys are replaced; without it they are appended.
    Model deltas are taken after the base reports are written, since those feed them.
    """
    with run(store.spark):
        try:
            return _refreshed(store, inputs, replace)
        finally:
            inputs._tagged.clear()


def _refreshed(store: ReportStore, inputs: RefreshInputs, replace: bool) -> RefreshResult:
    reports, models = _due(inputs)
    ledger = ledgers.request_ledger(
        inputs.history, inputs.log, inputs.params, inputs.request_type, inputs.clock_from
    )
    ledger = materialise(ledger)
    current = ledgers.reportable(ledger)
    every = new_keys(current, None, fixed.LEDGER_KEYS)
    delta = materialise(new_keys(current, store.read_if_exists(LEDGER), fixed.LEDGER_KEYS))
    quiet = delta.isEmpty()
    tables = [r.name for r in reports] + [m.name for m in models] + [LEDGER, PARAMS, DATES]
    if quiet and all(map(store.exists, tables)):
        if all(_scenarios(store, inputs, m).isEmpty() for m in models):
            return RefreshResult([])

    written = []
    for report in reports:
        known = store.exists(report.name)
        if known and quiet:
            continue
        keys = delta if known else every
        rows = with_audit_column(report.build(inputs, keys))
        layout = list(report.partition_by)
        if replace:
            on = dict(zip(report.keys, fixed.LEDGER_KEYS))
            store.replace_keys(rows, report.name, keys, on, layout)
        else:
            store.append(rows, report.name, layout)
        written.append(report.name)
    for report in models:
        scenarios = _scenarios(store, inputs, report)
        if store.exists(report.name) and scenarios.isEmpty():
            continue
        rows = report.build(store.read(report.base), inputs.models, scenarios)
        store.append(rows, report.name, list(fixed.REPORT_KEYS))
        written.append(report.name)
    if not quiet or not store.exists(PARAMS) or not store.exists(LEDGER):
        newest = ledgers.newest_first(ledgers.request_params(inputs.params, ledger))
        store.full_replace(newest, PARAMS)
        store.full_replace(ledgers.process_time_state(ledger), LEDGER)
        written += [PARAMS, LEDGER]
    if not store.exists(DATES):
        store.write_once(dates.dates_dim(store.spark), DATES)
        written.append(DATES)
    checked = ledgers.request_reconciliation(
        inputs.history, inputs.log, inputs.params, store.read(PARAMS), inputs.request_type
    )
    return RefreshResult(written, checked)


def reset_and_refresh(
    store: ReportStore, inputs: RefreshInputs, dropped: tuple[str, ...] = ("generic_launches",)
) -> RefreshResult:
    """Forget which requests were seen, drop some reports, and run anew, replacing all keys."""
    for name in (LEDGER, *dropped):
        store.drop(name)
    return refresh(store, inputs, replace=True)


@dataclass
class ShareInputs:
    """What the market-share refreshes read."""

    parameters: DataFrame
    params: DataFrame
    revenue: DataFrame
    buckets: DataFrame
    specialty: DataFrame
    specialty_bucket: str


def refresh_shares(store: ReportStore, inputs: ShareInputs) -> None:
    """Market share of all scenarios, in place of whatever the table holds."""
    with run(store.spark):
        rows = mshare.declared_share_rows(mshare.mshare_full(**vars(inputs)))
        store.replace_declared(rows, SHARES, mshare.SHARE_SCHEMA, mshare.SHARE_PARTITIONS)


def refresh_new_shares(store: ReportStore, inputs: ShareInputs) -> None:
    """Market share of the scenarios the table lacks, added to it."""
    with run(store.spark):
        store.create_declared(SHARES, mshare.SHARE_SCHEMA, mshare.SHARE_PARTITIONS)
        new = mshare.mshare_increment(**vars(inputs), reported=store.read(SHARES))
        rows = materialise(mshare.declared_share_rows(new))
        store.insert_declared(rows, SHARES)
