"""Log files to tables: the steps of the library composed, each staged at most once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.operators import context, entities, entries, quality, schemas, structs
from tracklake.operators.lookup import HOT_ROWS
from tracklake.sources.control import RECORD_COLUMNS, decode_records
from tracklake.sources.framing import scan_frames
from tracklake.sources.logfiles import (
    WHOLE_FILE_BYTES,
    header_problems,
    list_files,
    read_files,
    recordings,
    with_header,
    with_recording,
)
from tracklake.sources.ranges import large_logs, scan_ranges
from tracklake.session import stage


@dataclass
class Ingest:
    """Lazily built tables of a set of log files.

    ``files`` is (recording, path, content). ``large`` is (recording, path, length) of
    files that are framed by byte range. Every table is a DataFrame; the ones that several
    others read are written once to the staging folder.
    """

    files: DataFrame | None
    large: DataFrame | None = None
    mode: str = "PERMISSIVE"
    application_id: str | None = None
    trigger: str = "direct"
    min_rows: int = HOT_ROWS
    keyed_rows: DataFrame | None = None  # start from keyed records instead of files

    @cached_property
    def decoded(self) -> DataFrame:
        """Everything in the files, read once and written by part: the few header, control
        and problem rows can then be read without the data."""
        frames = scan_frames(with_header(self.files), self.mode)
        if self.large is not None and not self.large.isEmpty():
            frames = frames.unionByName(scan_ranges(large_logs(self.large), self.mode))
        rows = decode_records(frames, self.mode)
        part = (
            F.when(F.col("head").isNotNull(), "header")
            .when(F.col("issue").isNotNull(), "problem")
            .when(F.col("kind") == "raw", "data")
            .otherwise("control")
        )
        return stage(rows.withColumn("part", part), "records", "part")

    @property
    def found_recordings(self) -> DataFrame:
        """(recording) of every file that was read, also of those without a usable header."""
        found = self.files.select("recording")
        return found if self.large is None else found.unionByName(self.large.select("recording"))

    @cached_property
    def recordings(self) -> DataFrame:
        return recordings(self.decoded.filter("part = 'header'"), self.application_id)

    @cached_property
    def header_problems(self) -> DataFrame:
        return header_problems(self.decoded.filter("part = 'header'"))

    @cached_property
    def records(self) -> DataFrame:
        return self.decoded.filter("part in ('data', 'control')").select(*RECORD_COLUMNS)

    @cached_property
    def entry_defs(self) -> DataFrame:
        return context.entry_defs(self.decoded.filter("part = 'control'"), self.min_rows)

    @cached_property
    def with_context(self) -> DataFrame:
        starts, data = self.decoded.filter("part = 'control'"), self.decoded.filter("part = 'data'")
        return context.attach_context(data, starts, min_rows=self.min_rows)

    @cached_property
    def keyed(self) -> DataFrame:
        return context.keyed(self.with_context) if self.keyed_rows is None else self.keyed_rows

    @cached_property
    def schemas(self) -> DataFrame:
        return stage(schemas.schemas(self.keyed), "schemas")

    @cached_property
    def schema_fields(self) -> DataFrame:
        return schemas.schema_fields(self.schemas)

    @cached_property
    def layouts(self) -> DataFrame:
        return stage(schemas.layouts(schemas.versions(self.schemas, self.min_rows)), "layouts")

    @cached_property
    def struct_layout(self) -> DataFrame:
        return schemas.struct_layout(self.layouts)

    @cached_property
    def _decode_versions(self) -> DataFrame:
        return stage(structs.decode_versions(self.layouts, self.min_rows), "decode-versions")

    @cached_property
    def _leaf_cells(self) -> DataFrame:
        return stage(schemas.leaf_cells(self.layouts), "leaf-cells")

    def _attach_layout(self, keyed: DataFrame) -> DataFrame:
        if self.schemas.isEmpty():
            return structs.without_layout(keyed)
        return structs.attach_layout(keyed, self._decode_versions, min_rows=self.min_rows)

    @cached_property
    def with_layout(self) -> DataFrame:
        return self._attach_layout(self.keyed)

    @cached_property
    def unresolved(self) -> DataFrame:
        return structs.unresolved(self.with_layout)

    @cached_property
    def entry_names(self) -> DataFrame:
        """(recording, key, compound) of the entries: from the Start records where there are any, else a row per record."""
        if self.keyed_rows is None:
            named = self.entry_defs.select("recording", "key", "entry_type")
        else:
            named = self.keyed.select("recording", "key", "entry_type")
        compound = F.startswith("entry_type", F.lit("struct:")) | F.endswith("entry_type", F.lit("[]"))
        return named.withColumn("compound", compound).drop("entry_type")

    @cached_property
    def cells(self) -> tuple[DataFrame, bool]:
        """All cells, each marked whether another write may meet it, and whether any is."""
        marked, some = entries.mark_contested(self.keyed, self.entry_names, self.min_rows)
        cells = structs.plain_cells(marked)
        if not self.schemas.isEmpty():
            more = structs.struct_cells(self._attach_layout(marked), self._leaf_cells, self.min_rows)
            cells = cells.unionByName(more)
        return cells, some

    @cached_property
    def entries(self) -> DataFrame:
        """The entry log, not stored: filters on key or time and the choice of columns reach
        down to the undecoded records."""
        return entries.entries(*self.cells)

    @cached_property
    def stored_entries(self) -> DataFrame:
        return stage(self.entries, "entries")

    @cached_property
    def component_rows(self) -> DataFrame:
        return stage(entities.component_rows(self.stored_entries, self.trigger, self.min_rows), "component-rows")

    @cached_property
    def entity_rows(self) -> DataFrame:
        return entities.entity_rows(self.component_rows)

    @cached_property
    def quarantine(self) -> DataFrame:
        """All unusable rows up to and including value decode, then the components."""
        return quality.union_all(
            [
                quality.quarantine(self.header_problems, "header"),
                quality.quarantine(self._record_problems, "record", F.col("issue")),
                quality.quarantine(context.orphans(self.with_context), "context", F.lit("no context")),
                quality.value_problems(self.keyed),
                structs.struct_problems(self.with_layout),
                entities.component_problems(self.component_rows),
            ]
        )

    @property
    def _record_problems(self) -> DataFrame:
        return self.decoded.filter("part = 'problem'")


def ingest_path(spark: SparkSession, path: str, glob: str = "*.wpilog", **options) -> Ingest:
    """Every log file below ``path``: small ones whole, large ones by byte range."""
    large = with_recording(large_files(spark, path, glob))
    return Ingest(with_recording(read_files(spark, path, glob)), large, **options)


def large_files(spark: SparkSession, path: str, glob: str = "*.wpilog") -> DataFrame:
    return list_files(spark, path, glob).filter(F.col("length") > WHOLE_FILE_BYTES)


def ingest_contents(contents: DataFrame, recording: Column | None = None, **options) -> Ingest:
    """Log files already held as rows of (path, content)."""
    return Ingest(with_recording(contents, recording), **options)
