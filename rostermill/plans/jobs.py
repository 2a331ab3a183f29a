"""Complete jobs: take files, load them, keep everything, commit.

The driver only composes and starts Spark jobs; the one thing it holds is
the commit record. Every job writes its intermediate tables to the store's
shared folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.codes import relationship_table
from rostermill.operators.registry import (
    lineage_struct,
    outcomes,
    raw_dump,
    register_files,
    skip_registered_files,
    status_events,
)
from rostermill.operators.quality import check_unique
from rostermill.plans.backfill import backfill_names, backfill_products_and_dates
from rostermill.plans.claims import claim_rows, correct_claims, load_claims
from rostermill.plans.eligibility import load_eligibility
from rostermill.plans.run import Result, StoreRun
from rostermill.schemas import (
    CLAIM_COLUMNS,
    CLAIM_REQUIRED,
    CORRECTION_COLUMNS,
    ELIGIBILITY_COLUMNS,
    ENROLLEE_COLUMNS,
)
from rostermill.sources.files import list_input_files, listed_paths, scan_new_lines
from rostermill.sources.fixed_width import (
    file_layouts,
    first_heads,
    layout_problems,
    parse_shared_layout,
    read_reports,
    shared_heads,
    shared_layout_problems,
)
from rostermill.sources.workbook import (
    Sheet,
    list_sheets,
    parse_workbooks,
    rank_sheets,
    sheet_rows,
    workbook_files,
)
from rostermill.storage import TableStore

READ_SHEETS = ["ENROLLEES", "ELIGIBILITY", "CLAIMS"]

_OUTCOMES = "path string, module string, status string"
_REJECTS = "file string, step string, row_key string, reason string"


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def _file_rejects(problems: DataFrame) -> DataFrame:
    return problems.select(
        F.col("_file").alias("file"),
        F.lit("file").alias("step"),
        F.lit("").alias("row_key"),
        F.col("_problem").alias("reason"),
    )


class Ingest:
    """Loads new input files of one kind into a store.

    ``environment`` prefixes archive keys. With ``allow_duplicates`` a file
    name that is already registered is loaded again.
    """

    def __init__(
        self, store: TableStore, environment: str = "local", allow_duplicates: bool = False,
        guard_skew: bool = True,
    ):
        self.store = store
        self.spark: SparkSession = store.spark
        self.environment = environment
        self.allow_duplicates = allow_duplicates
        self.guard_skew = guard_skew

    # -- one run ----------------------------------------------------------

    def new_files(self, listed: DataFrame) -> DataFrame:
        if self.allow_duplicates:
            return listed
        return skip_registered_files(listed, self.current_registry())

    def current_registry(self) -> DataFrame:
        return self.store.read("registry")

    def failed_files(self, module: str) -> DataFrame:
        """(path) of the files whose last load by the module failed."""
        newest = F.max_by("status", "run").alias("status")
        return (
            self.store.read_appended("file_outcomes", _OUTCOMES)
            .where(F.col("module") == module)
            .groupBy("path")
            .agg(newest)
            .where("status = 'Failed'")
            .select("path")
        )

    def register(self, files: DataFrame, run: int, module: str, backup: bool) -> DataFrame:
        """Registry rows of the run's files, written before loading starts."""
        rows = register_files(files, module, self.environment, _now(), backup)
        rows = rows.withColumn("module", F.lit(module))
        staged = self.store.stage(f"{module.rsplit('/', 1)[-1]}_files", run, rows)
        start = status_events(staged, "Processing", _now(), F.lit(None))
        self.store.append("status_history/phase=start", run, start)
        return staged

    def received(self, registered: DataFrame) -> Column:
        """When the run received its files: one moment for all of them."""
        return F.lit(registered.agg(F.max("receivedAt")).first()[0]).cast("timestamp_ntz")

    def finish(self, run: int, files: DataFrame, result: Result, tag: str | None = None) -> None:
        """Write rejects, final statuses and the registry, then commit."""
        rejects = self.spark.createDataFrame([], _REJECTS)
        if result.rejects is not None:
            rejects = rejects.unionByName(result.rejects)
        self.store.append("rejects", run, rejects)
        kept = self.spark.read.schema(_REJECTS).parquet(f"{self.store.root}/rejects/run={run}")
        end = outcomes(files, kept, _now())
        self.store.append("status_history/phase=end", run, end)
        done = self.spark.read.schema(end.schema).parquet(
            f"{self.store.root}/status_history/phase=end/run={run}"
        )
        final = (
            files.drop("status", "reason", "path")
            .join(done.select(F.col("document").alias("_id"), "status", "reason"), "_id")
            .select(*self.store.read("registry").columns)
        )
        self.store.write("registry", run, final)
        ended = files.drop("status").join(
            done.select(F.col("document").alias("_id"), "status"), "_id"
        )
        self.store.append("file_outcomes", run, ended.select("path", "module", "status"))
        self.store.commit(run, tag)

    def duplicate_keys(self) -> DataFrame:
        """(table, key, n_rows) of stored business keys that are not unique."""
        keys = {"enrollee": "referenceId", "claim": "CLAIM_ID"}
        found = [
            check_unique(self.store.read(table), [key]).select(
                F.lit(table).alias("table"), F.col(key).alias("key"), "n_rows"
            )
            for table, key in keys.items()
        ]
        return found[0].unionByName(found[1])

    def unread_sheets(self, folder: str) -> DataFrame:
        """(path, sheet, priority) of known sheets that no load reads."""
        paths = listed_paths(list_input_files(self.spark, folder, "xlsx"))
        ranked = rank_sheets(list_sheets(workbook_files(self.spark, paths)))
        return ranked.where(~F.col("sheet").isin(*READ_SHEETS)).select("path", "sheet", "priority")

    # -- claim reports ----------------------------------------------------

    def claim_rows_into(
        self, run: int, rows: DataFrame, files: DataFrame, module: str, file_type: str,
        dump: bool, backup: bool, problems: DataFrame | None = None, tag: str | None = None,
    ) -> Result:
        """Load claim rows as one run; files with ``problems`` (_file,
        _problem) end as Failed."""
        registered = self.register(files, run, module, backup)
        lineage = lineage_struct(registered, file_type)
        staged = self.store.stage("claims", run, claim_rows(rows))
        single = registered.limit(2).count() < 2
        result = load_claims(staged, StoreRun(self.store, run, self.guard_skew), lineage, single)
        if problems is not None:
            result.add_rejects(_file_rejects(problems))
        if dump:
            self.store.append("dump_claims", run, raw_dump(rows, self.received(registered)))
        self.finish(run, registered, result, tag)
        return result

    def claim_reports(
        self, folder: str, shared_layout: bool = False, only: DataFrame | None = None
    ) -> Result | None:
        """All new ``.rpt`` files below ``folder`` as one run.

        ``only`` (path) restricts them, here and in other jobs.
        """
        run = self.store.next_run()
        files = self.store.stage("new_files", run, self._listed(folder, "rpt", only))
        n_files, since, first = files.agg(
            F.count("*"), F.min("modificationTime"), F.min("path")
        ).first()
        if not n_files:
            return None
        scanned = scan_new_lines(self.spark, folder, "rpt", files, since)
        lines = self.store.stage("lines", run, scanned)
        if shared_layout:
            both = first_heads(self.spark, [first])
            heads = self.store.stage("heads", run, shared_heads(lines, *both))
            problems = shared_layout_problems(heads)
            rows = parse_shared_layout(
                lines, CLAIM_COLUMNS, *both, skip_others=True, heads=heads
            )
        else:
            layouts = self.store.stage("layouts", run, file_layouts(lines, CLAIM_COLUMNS))
            problems = layout_problems(layouts, CLAIM_REQUIRED)
            rows = read_reports(lines, n_files, CLAIM_COLUMNS, CLAIM_REQUIRED, layouts)
        return self.claim_rows_into(
            run, rows, files, "claim_rpt", "rpt", dump=False, backup=False, problems=problems
        )

    def claim_workbooks(self, folder: str) -> Result | None:
        """Sheet CLAIMS of all new workbooks, with a raw dump."""
        files, paths = self._new_books(folder)
        if not paths:
            return None
        run, books = self.store.next_run(), workbook_files(self.spark, paths)
        want = {"CLAIMS": Sheet(CLAIM_COLUMNS, CLAIM_REQUIRED, must_exist=True)}
        rows, problems = self._sheets(run, books, want)
        return self.claim_rows_into(
            run, rows["CLAIMS"], files, "provider_claim", "xlsx", dump=True, backup=False,
            problems=problems,
        )

    def claim_corrections(self, folder: str) -> Result | None:
        """Sheet CLAIMS (claim, insured id) applied to stored claims."""
        files, paths = self._new_books(folder)
        if not paths:
            return None
        run, books = self.store.next_run(), workbook_files(self.spark, paths)
        registered = self.register(files, run, "provider_claim", backup=False)
        want = {"CLAIMS": Sheet(CORRECTION_COLUMNS, CORRECTION_COLUMNS, must_exist=True)}
        rows, problems = self._sheets(run, books, want)
        result = correct_claims(
            rows["CLAIMS"], StoreRun(self.store, run, self.guard_skew), lineage_struct(registered, "xlsx")
        )
        result.add_rejects(_file_rejects(problems))
        self.finish(run, registered, result)
        return result

    # -- eligibility ------------------------------------------------------

    def _listed(self, folder: str, extension: str, only: DataFrame | None = None) -> DataFrame:
        listed = list_input_files(self.spark, folder, extension)
        return self.new_files(listed if only is None else listed.join(only, "path", "left_semi"))

    def _new_books(
        self, folder: str, only: DataFrame | None = None
    ) -> tuple[DataFrame, list[str]]:
        files = self._listed(folder, "xlsx", only)
        return files, listed_paths(files)

    def _sheets(
        self, run: int, books: DataFrame, want: dict[str, Sheet]
    ) -> tuple[dict[str, DataFrame], DataFrame]:
        """Rows of each sheet, and problems; all parsed in one pass and staged."""
        parsed = self.store.stage("sheets", run, parse_workbooks(books, want))
        rows = {name: sheet_rows(parsed, name, sheet.columns) for name, sheet in want.items()}
        return rows, parsed.where("_problem IS NOT NULL").select("_file", "_problem")

    def eligibility_workbooks(self, folder: str, only: DataFrame | None = None) -> Result | None:
        files, paths = self._new_books(folder, only)
        if not paths:
            return None
        books = workbook_files(self.spark, paths)
        return self.eligibility_books_into(self.store.next_run(), books, files)

    def eligibility_books_into(
        self, run: int, books: DataFrame, files: DataFrame, tag: str | None = None
    ) -> Result:
        """Sheets ENROLLEES and ELIGIBILITY of the given workbooks."""
        registered = self.register(files, run, "eligibility", backup=True)
        lineage = lineage_struct(registered, "xlsx")
        sheets = {"ENROLLEES": ENROLLEE_COLUMNS, "ELIGIBILITY": ELIGIBILITY_COLUMNS}
        want = {name: Sheet(columns, columns) for name, columns in sheets.items()}
        rows, problems = self._sheets(run, books, want)
        result = load_eligibility(
            rows["ENROLLEES"],
            rows["ELIGIBILITY"],
            StoreRun(self.store, run, self.guard_skew),
            lineage,
            relationship_table(self.spark),
        )
        result.add_rejects(_file_rejects(problems))
        at = self.received(registered)
        self.store.append("dump_enrollees", run, raw_dump(rows["ENROLLEES"], at))
        self.store.append("dump_eligibility", run, raw_dump(rows["ELIGIBILITY"], at))
        self.finish(run, registered, result, tag)
        return result

    # -- backfills --------------------------------------------------------

    def fix_patient_subscriber_names(self) -> Result:
        run = self.store.next_run()
        result = backfill_names(StoreRun(self.store, run, self.guard_skew))
        self.store.commit(run)
        return result

    def fix_eligibility_products_and_dates(self) -> Result:
        run = self.store.next_run()
        result = backfill_products_and_dates(StoreRun(self.store, run, self.guard_skew))
        self.store.commit(run)
        return result
