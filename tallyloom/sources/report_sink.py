"""A data source that writes ordered lines as one text file for each report.

Lines stream from the task to a pending file, so no report is ever held whole; the files get their names when all tasks are done. A task that runs again writes another pending file, and
only those of the attempts that count are named.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

NAME = "report_lines"


def _place(path: str):
    """File system and path of a location that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


@dataclass
class Written(WriterCommitMessage):
    files: list = field(default_factory=list)  # (report, pending file)


class ReportWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, iterator) -> Written:
        system, base = _place(self.path)
        pending = f"{base}/_pending-{self.job}"
        system.create_dir(pending)
        done, out, last = [], None, None
        for row in iterator:
            if row["report"] != last:
                if out:
                    out.close()
                if any(row["report"] == r for r, _ in done):
                    raise ValueError("lines of a report must follow each other")
                last = row["report"]
                done.append((last, f"{pending}/{uuid.uuid4().hex}"))
                out = system.open_output_stream(done[-1][1])
            out.write(((row["text"] or "") + "\n").encode())
        if out:
            out.close()
        return Written(done)

    def commit(self, messages) -> None:
        system, base = _place(self.path)
        for report, file in (f for m in messages if m for f in m.files):
            system.move(file, f"{base}/{report}.txt")
        self._clear(system, base)

    def abort(self, messages) -> None:
        self._clear(*_place(self.path))

    def _clear(self, system, base) -> None:
        from pyarrow import fs

        if system.get_file_info(f"{base}/_pending-{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{base}/_pending-{self.job}")


class ReportLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "report string, text string"

    def writer(self, schema, overwrite: bool) -> ReportWriter:
        return ReportWriter(self.options["path"])


def write_reports(lines: DataFrame, path: str, report: str = "report") -> None:
    """One file ``<report>.txt`` for each report of a line table (report, section_no, line_no, text); an existing file of that name is replaced."""
    spark: SparkSession = lines.sparkSession
    spark.dataSource.register(ReportLines)
    ordered = lines.withColumnRenamed(report, "report").repartition("report").sortWithinPartitions("report", "section_no", "line_no")
    ordered.select("report", "text").write.format(NAME).mode("append").option("path", path).save()
