"""The full audit job: gates -> findings -> score -> clean -> second pass -> master
-> reports, writing every artefact. Step timings are returned for the benchmark.

Each stage starts from written inputs (the landed tables, the written findings,
the cleaned tables), so no stage re-runs the lineage of an earlier one and a
lost executor only repeats the stage it was part of. ``AuditRun.close`` deletes
the intermediate tables of the run once its results are no longer needed.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from qualis.operators import checks as CH
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import keys as K
from qualis.operators import master as MS
from qualis.operators import reports as RP
from qualis.operators import score as SC
from qualis.operators import verify as VF
from qualis.rules import PRIMARY_KEY, TABLES, Rules
from qualis.session import cut, file_system, mark, release, together
from qualis.sources import readers as RD
from qualis.sources import sinks as SK


@dataclass
class AuditRun:
    findings: DataFrame
    score_raw: DataFrame
    cleaning: CL.CleaningResult
    findings_clean: DataFrame
    score_clean: DataFrame
    master: DataFrame
    timings: dict[str, float] = field(default_factory=dict)
    detection: DataFrame | None = None
    since: int = 0

    def close(self) -> None:
        """Delete the intermediate tables; written artefacts stay."""
        release(self.findings.sparkSession, self.since)


def run_audit(spark: SparkSession, tables: dict[str, DataFrame], rules: Rules, out_dir: str,
              manifest: DataFrame | None = None) -> AuditRun:
    """Audit loaded tables (all text, with _row_id). With a ``manifest`` of known
    defects the findings are compared with it in both directions (V1, V2)."""
    t: dict[str, float] = {}
    since = mark()
    CH.assert_file_level_schema(tables, rules)

    def step(name, fn):
        t0 = time.time()
        r = fn()
        t[name] = round(time.time() - t0, 3)
        return r

    repeated = step("repeated", lambda: cut(K.repeated_keys(CH.align(tables, rules)[0]["sales"], "sale_id")))
    findings = step("findings", lambda: FD.findings(tables, rules, repeated=repeated))
    _, score_raw, cleaning = together(
        spark,
        lambda: step("write_findings", lambda: SK.write_findings_by_layer(findings, f"{out_dir}/errors_report")),
        lambda: step("score_raw", lambda: cut(SC.score(findings, tables, rules))),
        lambda: step("clean", lambda: CL.clean(tables, findings, rules, repeated)))
    master = MS.build_master(cleaning.cleaned)

    def second_pass():
        again = step("findings_clean", lambda: FD.findings(cleaning.cleaned, rules))
        return again, step("score_clean", lambda: cut(SC.score(again, cleaning.cleaned, rules)))

    _, counts, _, (findings_clean, score_clean) = together(
        spark,
        lambda: step("write_fix_log", lambda: SK.write_table(cleaning.fix_log.unionByName(cleaning.escalations),
                                                             f"{out_dir}/fix_log")),
        lambda: cut(cleaning.counts),
        lambda: step("write_master", lambda: SK.write_table(master, f"{out_dir}/clean_master")),
        second_pass)
    cleaning.counts = counts
    reports = {
        "errors_summary": RP.errors_summary(findings, findings_clean, spark, rules),
        "findings_per_check": RP.findings_per_check(findings),
        "findings_by_severity": SC.by_severity(findings, spark),
        "top_classes": SC.top_classes(findings, 5),
        "before_after": RP.before_after(score_raw, score_clean),
        "cleaning_counts": counts,
        "cleaning_totals": CL.totals(cleaning),
        "residual_split": RP.residual_split(cleaning),
        "data_dictionary": RP.data_dictionary(tables, rules),
        "scores": score_raw.unionByName(score_clean),
    }
    step("write_reports", lambda: together(
        spark, *[lambda n=name, df=df: SK.write_table(df, f"{out_dir}/{n}") for name, df in reports.items()]))
    detection = None
    if manifest is not None:
        detection = step("detection", lambda: cut(VF.detection_summary(findings, manifest)))
        SK.write_table(detection, f"{out_dir}/detection")
        SK.write_table(VF.by_class(findings, manifest), f"{out_dir}/detection_by_class")
    return AuditRun(findings, score_raw, cleaning, findings_clean, score_clean, master, t, detection, since)


def load_landing(spark: SparkSession, landing: str, rules: Rules, files: dict[str, str],
                 csv_options: dict | None = None) -> dict[str, DataFrame]:
    """Gate and load a landing: every input must be there (IO4), every text file's
    own header must have the required columns (SCH_001). ``files`` maps each table
    to its file or folder below ``landing``: ``*.csv`` (or a folder that holds CSV)
    is read by header name (``csv_options``: ``multi_line``, ``sep``), anything else as Parquet."""
    RD.assert_inputs_present(spark, landing, files)
    out, problems, options = {}, [], dict(csv_options or {})
    sep = options.get("sep", ",")
    for t, name in files.items():
        path = f"{landing.rstrip('/')}/{name}"
        if name.endswith(".csv"):
            problems += [(t, r["file"], r["missing_column"])
                         for r in RD.header_problems(spark, path, rules.required(t), sep).limit(100).collect()]
            if problems:
                continue
            out[t] = RD.with_text_positions(RD.empty_to_null(
                RD.read_csv_text(spark, path, rules.required(t), **options)))  # a column that no file has stays absent
        else:
            df = RD.read_any_text(spark, path, "parquet")
            out[t] = RD.empty_to_null(df)
    if problems:
        raise CH.SchemaAbortError("SCH_001: " + "; ".join(f"{f} ({t}) lacks {c}" for t, f, c in problems))
    return dict(zip(out, together(spark, *[lambda df=df: cut(df) for df in out.values()])))


def audit_landing_folder(spark: SparkSession, landing: str, rules: Rules, out_dir: str, files: dict[str, str],
                         manifest: str = "injected_errors.json", csv_options: dict | None = None) -> AuditRun:
    """From files to report; a manifest in the landing is compared with the findings."""
    assert set(files) == set(TABLES) and set(PRIMARY_KEY) == set(TABLES)
    since = mark()
    tables = load_landing(spark, landing, rules, files, csv_options)
    path = f"{landing.rstrip('/')}/{manifest}"
    fs, p = file_system(spark, path)
    run = run_audit(spark, tables, rules, out_dir, RD.read_manifest(spark, path) if fs.exists(p) else None)
    run.since = since
    return run
