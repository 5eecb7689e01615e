"""Facade over an archive tree: the multi-step operations as Spark plans.

``Archive`` holds a session, the archive root and the exclusions; every
method returns DataFrames (plans) or writes through the sinks.  Nothing is
computed on the driver beyond small, bounded tables (layouts, per-source
reports, at most five panel-wave checks).
"""

from __future__ import annotations

import datetime
import hashlib
import json
import re
import uuid
from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators import catalog as C
from ..operators import conversion as CV
from ..operators import dictionary as D
from ..operators import panel as PN
from ..operators import revisions as R
from ..operators import sync as S
from ..operators import unpack as U
from ..operators import verify as V
from ..operators.layout import Layout, Variable
from ..session import cut_lineage
from ..sources import archives as A
from ..sources import workbook as WB
from .convert import convert_lines
from .sinks import _exists, flat_index, publish, publish_sorted, write_flat_index, write_layout_documents
from .snapshots import SnapshotTable

# A variable of a dictionary as ``operators.dictionary.parse_grid`` gives it.
_VARIABLE = ("var_no:bigint, row_no:bigint, name:string, start:int, width:int, end:int, question:string, label:string, "
             "section:string, period:string, category_note:string, categories:map<string,string>, storage_type:string")
_FINGERPRINT = ("struct<source_name:string,source_size:bigint,source_mtime_ns:bigint,layout_sha256:string,columns:string,"
                "all_string:boolean,output_format:string,conversion_format_version:int>")
_PROVENANCE = ("output string, source string, member string, layout_id string, layout string, rows long, columns int, "
               f"variables array<string>, text_values boolean, fingerprint {_FINGERPRINT}, written_at timestamp")
_MANIFEST = ("key string, survey string, path string, url string, size long, etag string, last_modified string, local string, "
             "sha256 string, adopted boolean")
_RUNS = "run string, step string, request string, result string, at timestamp"
# Fixed value: the index file name other tools look for beside flat outputs.
FLAT_INDEX_NAME = "pnadc.microdados.dicionarios.json"


@dataclass
class Archive:
    spark: SparkSession
    root: str
    exclude: tuple[str, ...] = P.DEFAULT_EXCLUDE
    output_layout: str = "nested"
    surveys: tuple[str, ...] = ("trimestral", "anual")
    _listing: DataFrame | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self.root = A.qualified(self.spark, self.root)
        self.exclude = P.check_exclusions(list(self.exclude))
        if self.output_layout not in ("nested", "flat"):
            raise ValueError(f"{self.output_layout!r} is no output layout: use 'nested' or 'flat'")

    @classmethod
    def including_superseded(cls, spark: SparkSession, root: str, **kw) -> "Archive":
        return cls(spark, root, exclude=P.without_default(kw.pop("exclude", P.DEFAULT_EXCLUDE)), **kw)

    # ------------------------------------------------------------- listing
    @property
    def originals(self) -> str:
        return f"{self.root}/originals"

    def _relative(self, uri: str) -> Column:
        """Path below the archive root, which may itself contain any folder name."""
        return F.col(uri).substr(F.lit(len(self.root) + 2), F.length(uri))

    def _spread(self, files: DataFrame) -> DataFrame:
        """File rows are small, files are not: one row may be hours of work, so rows never share a task by size."""
        return files.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "path")

    def listing(self) -> DataFrame:
        """ZIP archives under ``originals`` with their members (central
        directories only) and paths relative to the archive root."""
        if self._listing is None:
            files = A.file_listing(self.spark, self.originals)
            zips = files.filter(P.zip_suffix(F.col("path")))
            inv = A.archive_inventory(zips).withColumnRenamed("archive", "uri")
            loose = files.filter(~P.zip_suffix(F.col("path"))).select(
                F.col("path").alias("uri"), "size", "mtime", F.lit(True).alias("readable"),
                F.array().cast("array<string>").alias("members"), F.lit(None).cast("string").alias("error"),
                F.array().cast("array<string>").alias("text_members"))
            self._listing = inv.unionByName(loose).withColumn("path", self._relative("uri"))
        return self._listing

    def write_listing(self) -> DataFrame:
        """The listing as a table under ``metadata``, in path order over its part files; later calls of this object read it."""
        target = publish_sorted(self.listing(), ["path"], f"{self.root}/metadata/listing")
        self._listing = self.spark.read.schema(self.listing().schema).parquet(target)
        return self._listing

    # ------------------------------------------------------------- catalog
    def dictionaries(self) -> DataFrame:
        return C.discover_dictionaries(self.listing().filter(F.col("readable")), self.exclude)

    def microdata(self) -> DataFrame:
        return R.data_records(self.listing().filter(F.col("readable")), self.exclude)

    def layouts(self) -> DataFrame:
        """Parsed variables of every ``.xlsx`` dictionary (loose or inside a
        dictionary ZIP that was unpacked next to it)."""
        books = self.listing().filter(F.lower("uri").endswith(".xlsx")).select(F.col("uri").alias("path"))
        return D.parse_grid(WB.workbook_cells(books).drop("error"))

    def layout_catalog(self) -> DataFrame:
        """One row per dictionary source: unique slug id, scope, kind, year(s),
        listing order (path, then member position) as a sortable key."""
        found = self.dictionaries()
        name = P.file_name(F.coalesce(F.col("member"), F.col("path")))
        based = found.withColumn("slug_base", P.slug_base(name, F.col("scope"), F.col("anual_kind"), F.col("year")))
        slugged = C.assign_slugs(based, ["path", "member_pos"])
        return slugged.select(
            F.col("slug").alias("layout_id"),
            F.concat(F.lit("metadata/layouts/"), F.col("slug"), F.lit(".json")).alias("layout"),
            "scope", "anual_kind", "year", "years", F.col("path").alias("source"), "member",
            F.concat(F.col("path"), F.lit("\u0000"), F.lpad((F.col("member_pos") + 2).cast("string"), 8, "0"))
            .alias("layout_ord"),
        )

    def catalog(self, layouts: DataFrame | None = None) -> DataFrame:
        """Best dictionary per microdata record (``layouts`` as for
        ``operators.catalog.choose_layouts``; default: ``layout_catalog()``)."""
        layouts = layouts if layouts is not None else self.layout_catalog()
        data = self.microdata()
        text = F.concat(F.col("path"), F.lit(" "), F.array_join("text_members", " "))
        # Matching uses the catalog's year rule; the period columns used by
        # batch filters keep the file-name rule (see README, P13).
        keyed = data.withColumnRenamed("year", "period_year").select(
            "*", F.col("path").alias("source"), P.catalog_year(text).alias("year"))
        matched = C.choose_layouts(keyed, layouts)
        return matched.drop("year").withColumnRenamed("period_year", "year")

    # ----------------------------------------------------------- discovery
    def remote_files(self, pages: DataFrame, roots: dict[str, str], years: Iterable[int] | None = None,
                     quarters: Iterable[int] | None = None, metadata: DataFrame | None = None) -> DataFrame:
        """Remote listing from index pages: in-scope file links of each
        survey root, minus exclusions, then the period filter (shared
        documents always pass; quarters bind only the quarterly survey).

        ``pages``: page_id, url, html — one hop of the crawl, every page at once.
        ``roots``: survey → root directory URL.
        ``metadata``: what is known of the files (``url, size, etag, last_modified``); others are unknown.
        The result feeds ``sync_plan``.
        """
        self._check_quarters(quarters, roots)
        from ..functions import urls as UR
        from ..sources import pages as PG

        links = PG.page_links(pages)
        # Each page belongs to the survey whose root prefixes it: a CASE over
        # the (few) configured roots, so no join is needed.
        survey, root = None, None
        for name, url in roots.items():
            cond = F.col("page_url").startswith(url)
            survey = F.when(cond, F.lit(name)) if survey is None else survey.when(cond, F.lit(name))
            root = F.when(cond, F.lit(url)) if root is None else root.when(cond, F.lit(url))
        links = links.withColumn("survey", survey).withColumn("root", root).filter(F.col("survey").isNotNull())
        classified = PG.classify_links(links, F.col("root"))
        survey_of_root = None
        for name, url in roots.items():
            cond = F.col("root") == url
            survey_of_root = F.when(cond, F.lit(name)) if survey_of_root is None else survey_of_root.when(cond, F.lit(name))
        files = PG.local_files(classified).withColumn("survey", survey_of_root)
        files = files.withColumnRenamed("local_path", "path").filter(~P.excluded(F.col("path"), list(self.exclude)))
        found = files.filter(P.period_selected(F.col("path"), F.col("survey"), years, quarters)).select(
            "survey", "path", "url", F.concat(F.col("survey"), F.lit("/"), F.col("path")).alias("key"))
        if metadata is None:
            metadata = self.spark.createDataFrame([], "url string, size long, etag string, last_modified string")
        return found.join(metadata.select("url", "size", "etag", "last_modified"), "url", "left")

    @staticmethod
    def _check_quarters(quarters: Iterable[int] | None, surveys: Iterable[str]) -> None:
        """Quarters select files of the quarterly survey, so asking for them without it is a mistake."""
        if quarters and "trimestral" not in surveys:
            raise ValueError("quarters need the quarterly survey ('trimestral') among the surveys")

    # ---------------------------------------------------------------- sync
    def sync_plan(self, remote: DataFrame, manifest: DataFrame, local: DataFrame) -> DataFrame:
        return S.sync_plan(remote, manifest, local, self.surveys)

    def manifest_table(self) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/metadata/manifest", _MANIFEST, ["key"])

    def manifest(self) -> DataFrame:
        """What is recorded of every mirrored file."""
        return self.manifest_table().read()

    def record_transfers(self, plan: DataFrame, fetched: DataFrame | None = None) -> int:
        """Record the adopted files of a sync plan and those fetched (``key, sha256, ok``); returns the version.

        Only their rows are written; failures and all other files keep what is recorded."""
        if fetched is None:
            fetched = self.spark.createDataFrame([], "key string, sha256 string, ok boolean")
        return self.manifest_table().commit(S.manifest_updates(plan, fetched).drop("origin"))

    def local_files(self) -> DataFrame:
        """``key, size, readable`` of the files below ``originals``."""
        return self.listing().select(F.expr("substring(path, length('originals/') + 1)").alias("key"), "size", "readable")

    def verify(self, manifest: DataFrame, deep: bool = False) -> DataFrame:
        """Presence and size first; only files that pass and have a recorded hash are read,
        and with ``deep`` the archives among those that have none."""
        listing = A.file_listing(self.spark, self.originals).select("path", self._relative("path").alias("local"), "size")
        listed = listing.join(manifest.select("local", F.col("size").alias("_size"), F.length("sha256").alias("_hash")).distinct(), "local")
        sound = listed.filter(F.col("_size").isNull() | (F.col("_size") == F.col("size")))
        has_hash = F.coalesce(F.col("_hash") > 0, F.lit(False))
        digests = A.file_digests(self._spread(sound.filter(has_hash).select("path").distinct()))
        local = listing.join(digests.select("path", "digest"), "path", "left").select("local", F.col("size").alias("file_size"), "digest")
        crc = None
        if deep:
            zips = sound.filter(~has_hash & P.zip_suffix(F.col("path"))).select("path").distinct()
            crc = A.crc_check(self._spread(zips)).select(self._relative("archive").alias("local"), "crc_ok", "bad_member")
        return V.verify_files(manifest, local, crc)

    # -------------------------------------------------------------- unpack
    def unpack_plan(self, state: DataFrame | None = None, force: bool = False) -> DataFrame:
        state = self.unpack_state() if state is None else state
        zips = A.file_listing(self.spark, self.originals, zips_only=True).select(
            self._relative("path").alias("archive"), "size",
            (F.unix_micros("mtime") * 1000).alias("mtime_ns"), F.col("path").alias("uri"))
        return U.unpack_plan(zips, state, self.exclude, force)

    @property
    def _state_path(self) -> str:
        return f"{self.root}/metadata/unpack_state"

    def unpack_state(self) -> DataFrame:
        """What earlier runs unpacked: ``archive, size, mtime_ns, outputs``."""
        schema = "archive string, size long, mtime_ns long, outputs array<string>"
        if not _exists(self.spark, self._state_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._state_path)

    def unpack(self, plan: DataFrame) -> DataFrame:
        """Unpack what the plan says and record it: a later plan skips what is unchanged.

        An archive that could not be unpacked is not recorded, so it is tried again."""
        plan = cut_lineage(plan)  # the recorded state is an input of the plan and is replaced below
        todo = plan.filter(F.col("action") == "process").select(
            F.col("uri").alias("path"), F.regexp_replace("archive", r"^originals/", "").alias("relative"))
        done = cut_lineage(A.unpack_archives(self._spread(todo), f"{self.root}/extracted"))
        made = done.groupBy(F.col("archive").alias("uri")).agg(
            F.max(F.col("error").isNotNull()).alias("failed"),
            F.collect_list(self._relative("output")).alias("outputs")).filter(~F.col("failed"))
        processed = plan.join(made, "uri").select("archive", "size", "mtime_ns", "outputs")
        kept = plan.filter(F.col("action") != "process").filter(F.col("previous_outputs").isNotNull()).select(
            "archive", F.col("s_size").alias("size"), F.col("s_mtime_ns").alias("mtime_ns"), F.col("previous_outputs").alias("outputs"))
        publish(self.spark, processed.unionByName(kept), self._state_path, "parquet", force=True)
        return done

    # ------------------------------------------------------------- convert
    def convert(self, sources: Sequence[str], layout: Layout | str, output_root: str, output_format: str = "parquet",
                columns: Iterable[str] | None = None, all_string: bool = False, force: bool = False,
                member: str | None = None, encoding: str = "utf-8") -> DataFrame:
        """Convert the text member of every listed ZIP with one layout (one job).

        A ZIP member is one deflate stream, so each archive is decompressed by
        one task; the lines are then dealt out by blocks for the (heavier)
        parse, so one huge archive does not leave the parse in a single task.
        Every listed archive is in the report, readable or not.  ``layout``
        may be the path of a layout document.  What was converted is recorded in
        the provenance of ``output_root``, with a hash of the layout's fields."""
        document = layout if isinstance(layout, str) else None
        if document is not None:
            layout = Layout.read(self.spark, document)
        columns = list(columns) if columns is not None else None
        archives = self.spark.createDataFrame([(s, member) for s in sources], "path string, member string")
        report = convert_lines(self.spark, self._member_lines(archives, encoding), layout, output_root, output_format,
                             columns, all_string, force, A.member_bytes(self._spread(archives)).withColumnRenamed("path", "source"))
        names = [v.name for v in layout.select(columns)]
        fields = "\n".join(f"{v.name} {v.start} {v.width}" for v in layout.variables)
        made_from = [r["source"] for r in report.filter("status = 'converted'").select("source").collect()]  # some of ``sources``
        if not made_from:
            return report
        sizes = A.file_listing(self.spark, made_from).withColumnRenamed("path", "uri")
        files = archives.distinct().join(sizes, F.col("path") == F.col("uri"))
        roots = "|".join(re.escape(root.rstrip("/")) for root in (A.qualified(self.spark, output_root), output_root))
        done = report.filter("status = 'converted'").join(files, F.col("source") == F.col("path")).select(
            F.regexp_replace("output", f"^(?:{roots})/", "").alias("output"), "source", "member", "rows",
            P.file_name(F.col("path")).alias("source_name"), F.col("size").alias("source_size"),
            (F.unix_micros("mtime") * 1000).alias("source_mtime_ns"), F.sha2(F.lit(fields), 256).alias("layout_sha256"))
        made = CV.expected_fingerprint(done, columns, all_string, output_format).select(
            "output", "source", "member", F.lit(None).cast("string").alias("layout_id"), F.lit(document).cast("string").alias("layout"), "rows",
            F.lit(len(names)).alias("columns"), F.lit(names if columns is not None else None).cast("array<string>").alias("variables"),
            F.lit(all_string or output_format == "csv").alias("text_values"), "fingerprint", F.current_timestamp().alias("written_at"))
        self.provenance(output_root).commit(made)
        return report

    # --------------------------------------- incremental conversion (M2)
    def _stored_layouts(self) -> DataFrame:
        schema = f"doc_id string, source_sha256 string, dictionary_sha256 string, variables array<struct<{_VARIABLE}>>"
        path = f"{self.root}/metadata/layout_store"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def layout_store(self, layouts: DataFrame | None = None, force: bool = False) -> DataFrame:
        """Every cataloged dictionary with its variables: ``doc_id, source_sha256, dictionary_sha256, variables, action``.

        Files are hashed; a dictionary whose file has the hash that was stored with it keeps what was read then (``keep``), new and
        changed ones are opened and read (``parse``), and those no longer cataloged are left out."""
        layouts = layouts if layouts is not None else self.layout_catalog()
        uris = self.listing().select(F.col("path").alias("source"), "uri")
        books = cut_lineage(layouts.join(uris, "source").select(F.col("layout_id").alias("doc_id"), "uri", "member"))
        files = A.file_digests(self._spread(books.select(F.col("uri").alias("path")).distinct()))
        hashed = books.join(files.select(F.col("path").alias("uri"), F.col("digest").alias("dictionary_sha256")), "uri")
        stored = self._stored_layouts()
        recorded = stored.select("doc_id", F.col("source_sha256").alias("dictionary_sha256"))
        plan = cut_lineage(D.layout_plan(hashed, recorded, force))
        todo = plan.filter("action = 'parse'")
        cells = cut_lineage(WB.workbook_cells(self._spread(todo.select(F.col("uri").alias("path"), "member", "doc_id")))
                            .filter(F.col("error").isNull()).drop("error"))
        fields = [name.split(":")[0] for name in _VARIABLE.split(", ")]
        variables = D.parse_grid(cells).groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("variables"))
        parsed = (todo.select("doc_id", F.col("dictionary_sha256").alias("source_sha256"))
                  .join(D.document_digest(cells), "doc_id", "left").join(variables, "doc_id", "left"))
        kept = stored.join(plan.filter("action = 'keep'").select("doc_id"), "doc_id", "left_semi")
        columns = ["doc_id", "source_sha256", "dictionary_sha256",
                   F.coalesce("variables", F.array().cast(stored.schema["variables"].dataType)).alias("variables")]
        return kept.select(*columns, F.lit("keep").alias("action")).unionByName(parsed.select(*columns, F.lit("parse").alias("action")))

    def layout_variables(self, store: DataFrame | None = None) -> DataFrame:
        """Variables of every cataloged dictionary, keyed by ``doc_id`` (its layout id)."""
        store = store if store is not None else self.layout_store()
        return store.select("doc_id", F.explode("variables").alias("v")).select("doc_id", "v.*")

    def generate_metadata(self) -> DataFrame:
        """Store the catalog under ``metadata``: layouts as read, layout documents and a table of data files with their dictionary.

        A later call opens only dictionaries that changed.  Returns the table (``path, name, scope, year, quarter, member, layout_id, score``)."""
        layouts = cut_lineage(self.layout_catalog())
        store = cut_lineage(self.layout_store(layouts))  # what is stored is an input and is replaced below
        publish(self.spark, store.drop("action"), f"{self.root}/metadata/layout_store", "parquet", force=True)
        write_layout_documents(self.layout_variables(store), f"{self.root}/metadata/layouts", digests=store)
        matched = self.catalog(layouts)
        table = matched.select(*[c for c in ("path", "name", "scope", "anual_kind", "year", "quarter", "member", "layout_id", "score")
                                 if c in matched.columns])
        publish_sorted(table, ["path"], f"{self.root}/metadata/catalog")
        return self.spark.read.parquet(f"{self.root}/metadata/catalog")

    def provenance(self, output_root: str) -> SnapshotTable:
        """What each output was made from, by output."""
        return SnapshotTable(self.spark, f"{output_root.rstrip('/')}/_provenance", _PROVENANCE, ["output"])

    def recorded_provenance(self, output_root: str) -> DataFrame:
        """The fingerprint that each output was made with."""
        return self.provenance(output_root).read().select("output", "fingerprint")

    def plan_conversion(self, output_root: str, output_format: str = "parquet", scope: str | None = None,
                        years: Iterable[int] | None = None, quarters: Iterable[int] | None = None,
                        columns: Iterable[str] | None = None, all_string: bool = False,
                        force: bool = False, store: DataFrame | None = None) -> DataFrame:
        """Newest revision per output, then the batch filter, then the
        currency check of each expected fingerprint against the recorded one.

        status: ``convert`` / ``skipped`` / ``unresolved`` (no dictionary, or
        several text members and none chosen)."""
        self._check_quarters(quarters, self.surveys if scope is None else (scope,))
        layouts = cut_lineage(self.layout_catalog())
        store = store if store is not None else self.layout_store(layouts)
        matched = self.catalog(layouts)
        chosen = R.latest_revision(matched, output_format, flat=self.output_layout == "flat", path_col="path",
                                   tiebreak="uri")
        picked = R.batch_filter(chosen, scope, years, quarters)
        if self.output_layout == "flat":
            target = F.concat(P.flat_name(F.col("name"), F.col("scope")), F.lit("." + output_format))
        else:
            target = F.concat(P.nested_output(F.col("path"), F.col("scope")), F.lit("." + output_format))
        expected = picked.join(store.select(F.col("doc_id").alias("layout_id"), "dictionary_sha256"), "layout_id", "left").select(
            "*", target.alias("output"), F.col("name").alias("source_name"), F.col("size").alias("source_size"),
            (F.unix_micros(F.col("mtime")) * 1000).alias("source_mtime_ns"),
            F.col("dictionary_sha256").alias("layout_sha256"), F.size("text_members").alias("n_text"))
        expected = CV.expected_fingerprint(expected, columns, all_string, output_format)
        return CV.conversion_plan(expected, self.recorded_provenance(output_root), "output", force,
                                  self._present(output_root, output_format))

    def _present(self, output_root: str, output_format: str) -> DataFrame:
        """Outputs that are on disk, relative to ``output_root`` (folders that hold a part file)."""
        root = A.qualified(self.spark, output_root)
        if not _exists(self.spark, root):
            return self.spark.createDataFrame([], "output string")
        inside = A.file_listing(self.spark, root).select(F.col("path").substr(F.lit(len(root) + 2), F.length("path")).alias("path"))
        output = F.regexp_extract("path", rf"^(.*\.{output_format})/[^/]*$", 1)
        return inside.select(output.alias("output")).filter("output <> ''").distinct()

    def convert_catalog(self, output_root: str, output_format: str = "parquet", scope: str | None = None,
                        years: Iterable[int] | None = None, quarters: Iterable[int] | None = None,
                        columns: Iterable[str] | None = None, all_string: bool = False,
                        force: bool = False) -> DataFrame:
        """Run the plan: one conversion job per dictionary, its provenance recorded as soon as it is done.

        Returns one row ``converted, skipped, unresolved, reasons``; ``reasons``
        names each unresolved source with its cause.  The plan and the
        per-layout variables collected here are bounded by the number of
        files and dictionaries, not by the data."""
        columns = list(columns) if columns is not None else None
        store = cut_lineage(self.layout_store())
        plan = self.plan_conversion(output_root, output_format, scope, years, quarters, columns, all_string, force, store)
        rows = plan.select("uri", "member", "output", "layout_id", "layout", "status", "reason", "fingerprint", "path").collect()
        counts = {"converted": 0, "skipped": 0, "unresolved": 0}
        reasons: list[str] = []
        todo: dict[str, list] = {}

        def unresolved(path: str, why: str) -> None:
            counts["unresolved"] += 1
            reasons.append(f"{path}: {why}")

        for r in rows:
            if r["status"] == "convert":
                todo.setdefault(r["layout_id"], []).append(r)
            elif r["status"] == "skipped":
                counts["skipped"] += 1
            else:
                unresolved(r["path"], r["reason"])
        variables = self.layout_variables(store).filter(F.col("doc_id").isin(list(todo))).select(
            "doc_id", "row_no", "name", "start", "width").collect() if todo else []
        recorded = self.provenance(output_root)
        for layout_id, group in todo.items():
            own = sorted((v for v in variables if v["doc_id"] == layout_id), key=lambda v: v["row_no"])
            try:
                layout = Layout([Variable(v["name"], v["start"], v["width"]) for v in own])
                selected = layout.select(columns)
            except ValueError as exc:
                for r in group:
                    unresolved(r["path"], f"dictionary {layout_id}: {exc}")
                continue
            by_uri = {r["uri"]: r for r in group}
            provenance = []
            listed = self.spark.createDataFrame([(r["uri"], r["member"], r["output"]) for r in group],
                                                "path string, member string, output string")
            report = convert_lines(self.spark, self._member_lines(listed), layout, output_root, output_format, columns,
                                   all_string, force=True, sources=listed.join(A.member_bytes(self._spread(listed)), "path")
                                   .select(F.col("path").alias("source"), "output", "bytes"))
            for rep in report.collect():
                record = by_uri[rep["source"]]
                if rep["status"] != "converted":
                    unresolved(record["path"], rep["first_error"])
                    continue
                counts["converted"] += 1
                names = [v.name for v in selected]
                provenance.append((record["output"], record["path"], record["member"], layout_id, record["layout"], rep["rows"],
                                   len(names), names if columns is not None else None, all_string or output_format == "csv",
                                   record["fingerprint"], datetime.datetime.now(datetime.timezone.utc)))
            if provenance:  # with each dictionary, so that a broken run keeps what it has done
                recorded.commit(self.spark.createDataFrame(provenance, _PROVENANCE))
        if self.output_layout == "flat" and output_format == "parquet":
            produced = [(r["output"], [r["path"], r["layout_id"] or ""]) for r in rows
                        if r["status"] in ("convert", "skipped")]
            self.write_index(output_root, produced)
        return self.spark.createDataFrame(
            [(counts["converted"], counts["skipped"], counts["unresolved"], sorted(reasons))],
            "converted long, skipped long, unresolved long, reasons array<string>")

    def standardize(self, output_root: str, output_format: str = "parquet", survey: str | None = None,
                    years: Iterable[int] | None = None, quarters: Iterable[int] | None = None,
                    columns: Iterable[str] | None = None, all_string: bool = False, force: bool = False) -> tuple[int, int, int]:
        """Convert what the catalog knows; counts of converted, skipped and unresolved sources."""
        done = self.convert_catalog(output_root, output_format, survey, years, quarters, columns, all_string, force).first()
        return done["converted"], done["skipped"], done["unresolved"]

    def runs(self) -> SnapshotTable:
        """Steps that runs of ``update`` have finished."""
        return SnapshotTable(self.spark, f"{self.root}/metadata/runs", _RUNS, ["run", "step"])

    def update(self, pages: DataFrame, roots: dict[str, str], output_root: str, years: Iterable[int] | None = None,
               quarters: Iterable[int] | None = None, convert: bool = True, output_format: str = "parquet",
               columns: Iterable[str] | None = None, metadata: DataFrame | None = None,
               fetched: DataFrame | None = None) -> dict[str, object]:
        """Sync plan, catalog and conversion in one call: ``sync`` (files per status), ``cataloged``, ``conversion``.

        Transfers are not made here: files on disk are adopted, ``fetched`` records what others made.  Each finished step is
        recorded with its result, so a call after a broken one with the same request goes on behind its last step (conversion
        itself goes on behind the last dictionary, by provenance); once all are done the next call is a new run.
        ``resumed`` names the steps taken from the record."""
        years, quarters, columns = ([*x] if x is not None else None for x in (years, quarters, columns))
        self._check_quarters(quarters, roots)
        asked = json.dumps([sorted(roots.items()), years, quarters, convert, output_root, output_format, columns])
        request = hashlib.sha256(asked.encode()).hexdigest()
        table = self.runs()
        past = table.read().filter(F.col("request") == request).groupBy("run").agg(
            F.max("at").alias("at"), F.map_from_entries(F.collect_list(F.struct("step", "result"))).alias("steps"))
        last = past.orderBy(F.desc("at"), "run").first()
        known = dict(last["steps"]) if last is not None and "end" not in last["steps"] else {}
        run = last["run"] if known else uuid.uuid4().hex
        resumed = sorted(known)

        def step(name, work):
            if name not in known:
                known[name] = json.dumps(work())
                now = datetime.datetime.now(datetime.timezone.utc)
                table.commit(self.spark.createDataFrame([(run, name, request, known[name], now)], _RUNS))
            return json.loads(known[name])

        def sync():
            remote = self.remote_files(pages, roots, years, quarters, metadata)
            plan = cut_lineage(S.sync_plan(remote, self.manifest(), self.local_files(), tuple(roots)))
            self.record_transfers(plan, fetched)
            return {r["status"]: r["files"] for r in S.sync_summary(plan).collect()}

        scope = next(iter(roots)) if len(roots) == 1 else None
        result = {"sync": step("sync", sync), "cataloged": step("catalog", lambda: self.generate_metadata().count())}
        if convert:
            result["conversion"] = step("convert", lambda: list(self.standardize(
                output_root, output_format, scope, years, quarters, columns)))
        step("end", lambda: True)
        return result | {"resumed": resumed}

    def write_index(self, output_root: str, produced: list | None = None) -> str:
        """Flat-layout index: one JSON line per ``*.parquet`` output (name,
        total size of its part files, origin), sorted by name."""
        root = output_root.rstrip("/")
        files = A.file_listing(self.spark, root).filter(F.col("path").contains(".parquet/"))
        sizes = files.select(F.regexp_extract("path", r"/([^/]+\.parquet)/[^/]+$", 1).alias("name"), "size") \
            .filter(F.col("name") != "").groupBy("name").agg(F.sum("size").alias("size"))
        made = self.spark.createDataFrame(produced or [], "name string, files array<string>")
        return write_flat_index(flat_index(sizes, made), f"{root}/{FLAT_INDEX_NAME}")

    def _member_lines(self, archives: DataFrame, encoding: str = "utf-8") -> DataFrame:
        """``source, line_no, offset, value, error`` of each archive's member (one task decompresses an archive)."""
        lines = A.archive_lines(self._spread(archives), None, encoding)
        return lines.select(F.col("archive").alias("source"), "line_no", "offset", "value", "error")

    # --------------------------------------------------------------- panel
    def panel(self, wave_paths: Sequence[str], panel_id: str, output: str, wide: bool = False,
              force: bool = False) -> DataFrame:
        """Write the panel in household, person and wave order, and its record (``<output>.json``), which is returned.

        The record's counts come from the written panel."""
        if _exists(self.spark, output) and not force:
            raise FileExistsError(f"{output} is there already (force=True replaces it)")
        waves = PN.read_waves(self.spark, wave_paths)
        long = PN.panel_long(waves, panel_id, names=[p.rsplit("/", 1)[-1] for p in wave_paths])
        result = PN.panel_wide(long, len(waves)) if wide else long
        publish(self.spark, PN.panel_order(result), output, "parquet", force)
        record = PN.panel_summary(self.spark.read.parquet(output), panel_id, wide)
        publish(self.spark, record.coalesce(1), f"{output.rstrip('/')}.json", "json", force=True)
        return record
