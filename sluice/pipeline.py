"""Runs of a feed: land, curate, reconcile, commit; replays and batches from the ledger.

A feed is described by ``Feed``; its tables are catalog tables. Every stage leaves
STARTED and SUCCESS or FAILED in the ledger, which is the only checkpoint there is.
"""

from __future__ import annotations

import argparse
import datetime as dt
import getpass
import json
import subprocess
import sys
import urllib.request
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import __version__, config
from sluice.operators import keys, ledger, merge, rejects, stamps
from sluice.operators.contract import Contract, curated_gate, enforce, explain, null_violations, resolve_header, type_changes
from sluice.operators.ledger import Counts
from sluice.operators.merge import MergeSpec
from sluice.operators.publish import SHRINK_PERCENT, Guards, append_control, append_raw, drop_partitions, droppable, publish
from sluice.operators.rejects import RejectRule
from sluice.operators.validate import cast_losses, content_violations, control_total
from sluice.session import cut
from sluice.sources import raw


#: How the raw event of a run says that an earlier one had landed its window.
SKIP_WINDOW = "skip_window"


class PipelineError(RuntimeError):
    """A run that must not go on; the message starts with its code."""


@dataclass
class Feed:
    entity: str
    read: Callable[[str], DataFrame]
    raw_table: str
    curated_table: str
    ledger_table: str
    spec: MergeSpec | None = None
    rejects_table: str | None = None
    contract: Contract | None = None
    reject_rules: list[RejectRule] = field(default_factory=list)
    max_reject_percent: float | None = None
    transforms: dict[str, str] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)
    derive: list[tuple[str, str]] = field(default_factory=list)
    normalize: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    idempotency_key: tuple[str, ...] = ()
    publish_mode: str = "MERGE"
    keep_keyless: bool = False
    record_hash: bool = False
    on_mismatch: str = "FAIL"
    file_type: str | None = None
    commit: Callable[[str], object] | None = None
    discard: Callable[[str], object] | None = None
    window: Callable[[str], tuple[str, str] | None] = lambda run_id: None
    hold_on_rejects: bool = False
    skip_loaded_files: bool = False
    control_total: str | None = None
    reject_payload: str | None = None
    on_finish: Callable[[dict], object] | None = None
    conf: dict = field(default_factory=dict)


def new_run_id(entity: str) -> str:
    return f"{entity[:3]}-{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:6]}"


@dataclass
class Run:
    spark: SparkSession
    feed: Feed
    run_id: str
    mode: str = "INCR"
    dry_run: bool = False
    resume: bool = False
    force: bool = False
    raw_flag: str | None = None
    file_id: str | None = None

    @property
    def flag(self) -> str:
        """What landed rows are marked with: as told, else by the feed, else F or I by the mode."""
        return self.raw_flag or self.feed.file_type or ("F" if self.mode == "FULL" else "I")

    def event(self, stage: str, status: str, message: str = "", c: Counts = Counts(), control_total: str | None = None) -> None:
        w = self.feed.window(self.run_id) or ("", "")
        row = (
            self.run_id, self.feed.entity, stage, status, c.source, c.raw, c.accepted, c.rejected, c.inserted, c.updated, c.deleted, control_total, ledger.sanitize(message),
            dt.datetime.now(dt.UTC).replace(tzinfo=None), self.mode, w[0], w[1], __version__, config.fingerprint(self.feed.conf), getpass.getuser(),
        )
        append_control(self.spark, self.feed.ledger_table, ledger.LEDGER_SCHEMA, [row])

    def runs(self) -> DataFrame | None:
        return self.spark.table(self.feed.ledger_table) if self.spark.catalog.tableExists(self.feed.ledger_table) else None

    @contextmanager
    def stage(self, name: str):
        """Records the stage's events; with resume a stage that has succeeded is skipped."""
        runs = self.runs()
        if self.resume and runs is not None:
            last = ledger.latest_status(runs.filter((F.col("run_id") == self.run_id) & (F.col("entity") == self.feed.entity) & (F.col("stage") == name))).first()
            if last and last.status == ledger.SUCCESS:
                self.event(name, ledger.SKIPPED, "resume")
                yield None
                return
        self.event(name, ledger.STARTED)
        box: dict = {"counts": Counts()}
        try:
            yield box
        except Exception as e:
            self.event(name, ledger.FAILED, str(e))
            raise
        self.event(name, ledger.SUCCESS, "dry-run" if self.dry_run else box.get("message", ""), box["counts"], box.get("control_total"))

    def landed(self) -> DataFrame:
        """What this run has to curate: its own rows, or those of its window where an earlier run had landed it."""
        raw_table, runs = self.spark.table(self.feed.raw_table), self.runs()
        w = self.feed.window(self.run_id)
        if w and runs is not None:
            own = runs.filter((F.col("run_id") == self.run_id) & (F.col("entity") == self.feed.entity) & ledger.succeeded(ledger.RAW))
            if not own.filter(F.col("message").startswith(SKIP_WINDOW)).isEmpty():
                own_rows = raw.window_slice(raw_table, w)
                return own_rows if self.file_id is None else own_rows.filter(F.col("file_id") == self.file_id)
        return raw.slice_of(raw_table, run_id=self.run_id, file_id=self.file_id)


def land(run: Run) -> Counts:
    """Reads, checks the contract, splits rejects off, and appends what hasn't landed yet."""
    f, spark = run.feed, run.spark
    with run.stage(ledger.RAW) as box:
        if box is None:
            return Counts()
        df = f.read(run.run_id)
        if f.contract:
            enforce([*type_changes(f.contract, df), *null_violations(f.contract, df)])
            bad = content_violations(df, f.contract.rules)
            if bad:
                raise PipelineError("; ".join(bad))
        w = f.window(run.run_id) or ("", "")
        df = stamps.stamp_raw(df, run.flag, stamps.Lineage(run.run_id, extract_start_ts=w[0], extract_end_ts=w[1]), source_file=F.lit(f.entity))
        df = stamps.stamp_hash(df) if f.record_hash else df
        classified = cut(rejects.classify(df, f.reject_rules))
        n = classified.agg(F.count(F.lit(1)).alias("n"), F.count("error_code").alias("bad")).first()
        rejects.check_limits(n.n, n.bad, max_percent=f.max_reject_percent)
        accepted = classified.filter(F.col("error_code").isNull()).drop("error_code", "error_message", "reject_category")
        passed = n.n - n.bad
        skipped, duplicates, notes = 0, -1, []
        landed = spark.table(f.raw_table) if spark.catalog.tableExists(f.raw_table) else None
        what = "APPEND"
        if landed is not None:
            held = w[1] != "" and run.runs() is not None and ledger.window_had_rejects(run.runs(), f.entity, run.run_id, *w)
            what = raw.decision(landed, run.run_id, w, held, run.force)
            if what == "APPEND" and w[1] and not run.force and raw.drifted_end(landed, run.run_id, w):
                notes.append(f"drift: the window from {w[0]} has landed with another end")
        if f.idempotency_key:
            duplicates = keys.duplicate_keys(accepted, list(f.idempotency_key), with_blank=True).count()
        if landed is not None and what == "APPEND" and (f.skip_loaded_files or f.idempotency_key):
            kept = raw.without_loaded_files(accepted, landed)[0] if f.skip_loaded_files else accepted
            kept = raw.not_landed(kept, landed, list(f.idempotency_key)) if f.idempotency_key else kept
            accepted = cut(kept)
            skipped = passed - accepted.count()
        written = -1
        if not run.dry_run and what == "APPEND":
            append_raw(accepted, f.raw_table, metadata=stamps.RAW_COLUMNS + stamps.LINEAGE_COLUMNS)
            if f.rejects_table:
                _store_rejects(_reject_rows(classified, run), run)
            written = raw.slice_of(spark.table(f.raw_table), run_id=run.run_id).count()
        elif not run.dry_run:
            # nothing is written; the rows to account for are those that have landed before
            own = raw.window_slice(landed, w) if what == "SKIP_WINDOW" else raw.slice_of(landed, run_id=run.run_id)
            written = passed = own.count()
        if f.control_total:
            box["control_total"] = control_total(accepted, f.control_total).first().control_total
        box["message"] = "; ".join(([] if what == "APPEND" else [what.lower()]) + notes)
        box["counts"] = Counts(source=n.n if what == "APPEND" else -1, raw=written, accepted=passed, rejected=n.bad, overlap_skipped=skipped, duplicate_versions=duplicates)
        return box["counts"]


def _store_rejects(rows: DataFrame, run: Run) -> None:
    """Rejects of a run as one slice: a run that comes again replaces what an earlier attempt left, if it differs."""
    table = run.feed.rejects_table
    mine = {"run_id": run.run_id, "entity": run.feed.entity}
    if not run.spark.catalog.tableExists(table) or run.spark.table(table).filter(reduce(and_, (F.col(k) == v for k, v in mine.items()))).isEmpty():
        if not rows.isEmpty():
            append_raw(rows, table)
        return
    new = rejects.replaced_slice(run.spark.table(table), rows, mine)
    if new is not None:
        publish(new, table, Guards(allow_empty=True))


def _reject_rows(classified: DataFrame, run: Run) -> DataFrame:
    data = [c for c in stamps.content_columns(classified) if c not in ("error_code", "error_message", "reject_category")]
    hidden = [c.name for c in run.feed.contract.columns if c.sensitive] if run.feed.contract else []
    return classified.filter(F.col("error_code").isNotNull()).select(
        F.lit(run.run_id).alias("run_id"), F.lit(run.feed.entity).alias("entity"), "file_id", "source_file", "row_idx",
        rejects.payload(data, run.feed.reject_payload or ("MASKED" if hidden else "FULL"), keys=list(run.feed.spec.keys) if run.feed.spec else [], sensitive=hidden).alias("raw_record"), "error_code", "error_message", "reject_category", F.current_timestamp().alias("reject_ts"),
    )


def curated_rows(feed: Feed, landed: DataFrame) -> DataFrame:
    """Landed rows as rows of the curated table: transforms, casts, derived and audit columns, keys."""
    df = landed.drop(*[c for c in (*stamps.RAW_COLUMNS, *stamps.LINEAGE_COLUMNS) if c not in feed.order])
    df = stamps.contract_transforms(df, feed.transforms)
    if feed.types:
        lost = [r for r in cast_losses(df, feed.types).collect() if r.n_lost]
        if lost:
            raise PipelineError("CUR_003 values would be lost by casts: " + ", ".join(f"{r.column_name} ({r.n_lost})" for r in lost))
    df = stamps.stamp_audit(stamps.derive(stamps.cast_columns(df, feed.types), feed.derive))
    return keys.normalize_keys(df, feed.normalize) if feed.normalize else df


def curate(run: Run, landed: DataFrame) -> Counts:
    """Merges landed rows into the curated table, or replaces it."""
    f, spark = run.feed, run.spark
    with run.stage(ledger.CURATED) as box:
        if box is None:
            return Counts()
        df = curated_rows(f, landed)
        if f.contract:
            enforce(curated_gate(df, f.contract, list(f.spec.keys) if f.spec else [], []))
        total, exists = df.count(), spark.catalog.tableExists(f.curated_table)
        keyless_n = n_keys = 0
        keyless = df.limit(0)
        if f.spec:
            valid, keyless = merge.prepare_batch(df, f.spec, list(f.order))
            keyless_n, n_keys = keyless.count(), valid.count()
            if f.spec.compare_as or f.spec.compare_format:
                merge.check_freshness(df, f.spec)
            df = valid
        base = Counts(accepted=total, blank_key=0 if f.keep_keyless else keyless_n, passthrough=keyless_n if f.keep_keyless else 0, deduped=total - keyless_n - n_keys if f.spec else 0)
        full = f.spec is None or not exists or f.publish_mode == "FULL_OVERWRITE" or run.mode == "FULL"
        partitions = None
        if full:
            target = spark.table(f.curated_table) if exists else None
            out = merge.full_publish(df, target, f.spec) if f.spec else df.withColumn(merge.OUTCOME, F.lit(merge.INSERTED))
        elif f.publish_mode == "PARTITION_OVERWRITE":
            out, partitions = merge.scoped_merge(df, spark.table(f.curated_table), f.spec)
        else:
            out = merge.merge(df, spark.table(f.curated_table), f.spec)
        if f.keep_keyless and f.spec:
            out = merge.with_passthrough(out, keyless, [c for c in out.columns if c != merge.OUTCOME])
        box["counts"] = base
        if run.dry_run:
            seen = merge.outcome_counts(out).first()
        else:
            found: dict = {"gone": []}

            def inspect(staged: DataFrame) -> None:
                found["n"] = merge.outcome_counts(staged).first()
                if partitions is not None:
                    found["gone"] = droppable(merge.emptied_partitions(partitions, staged))

            unique = f.spec.keys if f.spec and not f.keep_keyless else ()
            shrink_base = None if partitions is None else merge.partition_slice(spark.table(f.curated_table), partitions).count()
            guards = Guards(allow_empty=partitions is not None or (full and total == 0), unique_keys=unique, max_shrink_percent=None if full else SHRINK_PERCENT, shrink_base=shrink_base)
            publish(out, f.curated_table, guards, partitions=f.spec.partition_columns if f.spec else (), scoped=partitions is not None, aside=(merge.OUTCOME,), inspect=inspect)
            seen = found["n"]
            if found["gone"]:
                drop_partitions(spark, f.curated_table, spark.createDataFrame(found["gone"], partitions.schema))
        box["counts"] = Counts(**(base.__dict__ | {"inserted": seen.inserted, "updated": seen.updated, "deleted": seen.deleted, "ignored": seen.ignored}))
        return box["counts"]


def _previous_window(run: Run) -> tuple[str, str] | None:
    """The window of the latest other run of the entity that landed one."""
    runs = run.runs()
    if runs is None:
        return None
    last = ledger.last_raw_window(runs.filter((F.col("entity") == run.feed.entity) & (F.col("run_id") != run.run_id))).first()
    return (last.window_start, last.window_end) if last else None


def run_feed(spark: SparkSession, feed: Feed, run_id: str | None = None, mode: str = "INCR", dry_run: bool = False, resume: bool = False, force: bool = False, raw_flag: str | None = None) -> tuple[str, list[ledger.Check]]:
    """Land, curate, reconcile, then commit the position; nothing is committed if a step fails or rejects hold it."""
    config.check(feed.conf)
    run = Run(spark, feed, run_id or new_run_id(feed.entity), mode, dry_run, resume, force, raw_flag)
    try:
        got = land(run)
        if dry_run:
            _finished(run, ledger.SUCCESS, "dry-run")
            return run.run_id, []
        cur = curate(run, run.landed())
        both = Counts(**(got.__dict__ | {k: v for k, v in cur.__dict__.items() if k not in ("source", "raw", "accepted", "rejected", "overlap_skipped", "duplicate_versions", "replayed")}))
        if got.overlap_skipped:
            both = Counts(**(both.__dict__ | {"accepted": both.accepted - got.overlap_skipped, "overlap_skipped": 0, "source": -1}))
        checks = ledger.reconcile(both, feed.window(run.run_id) if mode == "INCR" else None, _previous_window(run) if mode == "INCR" else None, dry_run)
        ledger.enforce(checks, feed.on_mismatch)
        if feed.commit and not (feed.hold_on_rejects and got.rejected > 0) and config.commits_watermark(feed.conf):
            feed.commit(run.run_id)
        elif feed.discard:
            feed.discard(run.run_id)
        _finished(run, ledger.SUCCESS, counts=both)
        return run.run_id, checks
    except Exception as e:
        if feed.discard:
            feed.discard(run.run_id)
        _finished(run, ledger.FAILED, str(e))
        raise


def _finished(run: Run, status: str, message: str = "", counts: Counts = Counts()) -> None:
    """Tells ``on_finish`` how a run ended; whatever goes wrong there is no failure of the run."""
    if run.feed.on_finish:
        try:
            run.feed.on_finish({"run_id": run.run_id, "entity": run.feed.entity, "mode": run.mode, "status": status, "message": ledger.sanitize(message), "counts": counts.__dict__})
        except Exception as e:  # noqa: BLE001
            print(f"on_finish of {run.run_id}: {ledger.sanitize(str(e))}", file=sys.stderr)


def replay(spark: SparkSession, feed: Feed, run_id: str, mode: str = "INCR", file_id: str | None = None) -> list[ledger.Check]:
    """Curates a landed run again, or one file of it; needs its raw SUCCESS and never touches the position."""
    run = Run(spark, feed, run_id, mode, file_id=file_id)
    runs = run.runs()
    batch = None if runs is None else ledger.batches(runs, feed.entity).filter(F.col("run_id") == run_id).first()
    if batch is None:
        raise PipelineError(f"PIPE_005 run {run_id} has no raw SUCCESS")
    counts = curate(run, run.landed())
    expected = runs.filter((F.col("run_id") == run_id) & ledger.succeeded(ledger.RAW)).agg(F.max("raw_count").alias("n")).first().n
    checks = ledger.reconcile(Counts(**(counts.__dict__ | {"accepted": -1, "replayed": -1 if expected is None or file_id else expected})))
    ledger.enforce(checks, feed.on_mismatch)
    return checks


def replay_day(spark: SparkSession, feed: Feed, ingest_dt: str, mode: str = "INCR", raw_flag: str | None = None) -> Counts:
    """Curates what has landed on a day under a flag, under a run of its own; never touches the position."""
    run = Run(spark, feed, new_run_id(feed.entity), mode, raw_flag=raw_flag)
    return curate(run, raw.slice_of(spark.table(feed.raw_table), ingest_dt=ingest_dt, file_type=run.flag))


def explain_mapping(feed: Feed) -> list[tuple[str, str, str]]:
    """(header, column, how it was found) for what the feed delivers now; nothing is landed."""
    if feed.contract is None:
        raise PipelineError("HDR_017 a feed without contract has no mapping")
    delivered = [c for c in feed.read(new_run_id(feed.entity)).columns if c != "source_file"]
    return explain(feed.contract, resolve_header(feed.contract, delivered))


def configured(feed: Feed, conf_path: str | None = None, override_path: str | None = None) -> Feed:
    """The feed with the configuration of a JSON file, and the values of another one over it."""
    conf = json.loads(Path(conf_path).read_text()) if conf_path else feed.conf
    if override_path:
        conf, changed, digest = config.override(conf, json.loads(Path(override_path).read_text()))
        print(f"override {digest[:12]}: {', '.join(changed) or 'adds only'}", file=sys.stderr)
    return replace(feed, conf=conf)


def drive_batches(spark: SparkSession, feed: Feed, select: str = "pending", n: int = 0, first_day: str = "", last_day: str = "", on_failure: str = "STOP", source_system: str | None = None) -> list[tuple[str, str]]:
    """Curates landed batches in commit order: pending, failed, last (``n``) or between (days); (run id, outcome) of each.

    ``source_system`` keeps those that landed rows of it.
    """
    if not spark.catalog.tableExists(feed.ledger_table):
        raise PipelineError("PIPE_006 batches need the ledger")
    runs = spark.table(feed.ledger_table)
    chosen = {
        "pending": lambda: ledger.pending(runs, feed.entity),
        "failed": lambda: ledger.failed_pending(runs, feed.entity),
        "last": lambda: ledger.last_batches(runs, feed.entity, n),
        "between": lambda: ledger.batches_between(runs, feed.entity, first_day, last_day),
    }
    if select not in chosen:
        raise PipelineError(f"PIPE_007 selection {select!r} must be one of {', '.join(chosen)}")
    batches = chosen[select]()
    if source_system is not None:
        if not spark.catalog.tableExists(feed.raw_table):
            raise PipelineError("PIPE_007 batches are chosen by source system from the landed table, which is missing")
        own = spark.table(feed.raw_table).filter(F.col("source_system") == source_system).select("run_id").distinct()
        batches = batches.join(own, "run_id", "left_semi")
    out = []
    for b in batches.orderBy("raw_success_ts", "run_id").toLocalIterator():
        if not b.run_mode:
            raise PipelineError(f"PIPE_008 run {b.run_id} has no mode in the ledger")
        try:
            replay(spark, feed, b.run_id, b.run_mode)
            out.append((b.run_id, ledger.SUCCESS))
        except Exception as e:  # noqa: BLE001 - the outcome is the batch's, the policy decides
            out.append((b.run_id, f"{ledger.FAILED}: {ledger.sanitize(str(e), 200)}"))
            if on_failure.upper() == "STOP":
                break
    return out


def notify(body: dict, webhook: str | None = None, command: list[str] | None = None, timeout: float = 10.0) -> bool:
    """Tells others about a run, as well as it can: a failure here never fails the run."""
    try:
        data = json.dumps(body).encode()
        if webhook:
            urllib.request.urlopen(urllib.request.Request(webhook, data, {"Content-Type": "application/json"}), timeout=timeout).close()  # noqa: S310
        if command:
            subprocess.run(command, input=data, timeout=timeout, check=True)  # noqa: S603
        return True
    except Exception:  # noqa: BLE001
        return False


def parse_arguments(argv: list[str]) -> argparse.Namespace:
    """Flags of a run; selections of batches exclude each other."""
    p = argparse.ArgumentParser(prog="sluice")
    p.add_argument("--feed", required=True, help="module:attribute of a function that takes a session and returns a Feed")
    p.add_argument("--stage", choices=["all", "raw", "curated", "validate"], default="all")
    p.add_argument("--run-id")
    p.add_argument("--mode", choices=["FULL", "INCR"], default="INCR")
    for flag in ("--dry-run", "--resume", "--force-reprocess"):
        p.add_argument(flag, action="store_true")
    one = p.add_mutually_exclusive_group()
    one.add_argument("--pending", action="store_true")
    one.add_argument("--failed", action="store_true")
    one.add_argument("--last", type=int)
    one.add_argument("--between", nargs=2, metavar=("FIRST", "LAST"))
    one.add_argument("--resume-ingest-dt", metavar="DAY", help="curates what has landed on a day")
    p.add_argument("--on-failure", choices=["STOP", "CONTINUE"], default="STOP")
    p.add_argument("--replay-source-system", metavar="SYSTEM", help="of the selected batches, or the pending ones, those of a source system")
    p.add_argument("--file-id", help="one file of a landed run")
    p.add_argument("--raw-flag", help="mark of landed rows; F for full and I for incremental runs by default")
    p.add_argument("--conf-path", help="JSON configuration in place of the feed's own")
    p.add_argument("--override-path", help="JSON values over the configuration")
    p.add_argument("--explain-mapping", action="store_true")
    p.add_argument("--validate-only", action="store_true")
    a = p.parse_args(argv)
    if a.validate_only:
        a.stage = "validate"
    chosen = a.pending or a.failed or a.last or a.between or a.replay_source_system
    if a.stage != "curated" and (chosen or a.resume_ingest_dt or a.file_id):
        p.error("batches, days and files are selected for --stage curated only")
    if a.stage == "curated" and not (a.run_id or chosen or a.resume_ingest_dt):
        p.error("--stage curated needs --run-id, a day or a selection of batches")
    if a.run_id and (chosen or a.resume_ingest_dt):
        p.error("a run and a selection of batches or a day exclude each other")
    if a.file_id and not a.run_id:
        p.error("--file-id needs --run-id")
    return a


def main(argv: list[str] | None = None) -> int:
    a = parse_arguments(sys.argv[1:] if argv is None else argv)
    module, _, name = a.feed.partition(":")
    spark = SparkSession.builder.getOrCreate()
    try:
        feed: Feed = getattr(__import__(module, fromlist=[name]), name)(spark)
        feed = configured(feed, a.conf_path, a.override_path)
        if a.explain_mapping:
            print("\n".join("\t".join(row) for row in explain_mapping(feed)))
            return 0
        config.check(feed.conf, a.stage)
        if a.stage == "validate":
            return 0
        if a.stage == "raw":
            land(Run(spark, feed, a.run_id or new_run_id(feed.entity), a.mode, a.dry_run, a.resume, a.force_reprocess, a.raw_flag))
        elif a.stage == "all":
            run_feed(spark, feed, a.run_id, a.mode, a.dry_run, a.resume, a.force_reprocess, a.raw_flag)
        elif a.run_id:
            replay(spark, feed, a.run_id, a.mode, a.file_id)
        elif a.resume_ingest_dt:
            replay_day(spark, feed, a.resume_ingest_dt, a.mode, a.raw_flag)
        else:
            kind = "pending" if a.pending else "failed" if a.failed else "last" if a.last else "between" if a.between else "pending"
            got = drive_batches(spark, feed, kind, a.last or 0, *(a.between or ("", "")), on_failure=a.on_failure, source_system=a.replay_source_system)
            return 0 if all(s == ledger.SUCCESS for _, s in got) else 20
        return 0
    except Exception as e:  # noqa: BLE001 - the exit code tells the class
        kind = config.classify(e)
        print(f"{kind.name}: {ledger.sanitize(str(e))}", file=sys.stderr)
        return kind.exit_code


if __name__ == "__main__":
    sys.exit(main())
