"""Delimited, JSON and XML exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

def export_delimited(df: DataFrame, path: str, sep: str = ",", quote_all: bool = False, single: bool = True) -> None:
    """Delimited text with header (K04, K05): one part if ``single``, as many as ``df`` has partitions otherwise.

    One part passes all rows through one task; the caller chooses, never the number of rows.
    """
    out = df.coalesce(1) if single else df
    (out.write.mode("overwrite").option("header", True).option("sep", sep).option("quoteAll", quote_all)
     .option("escape", '"').csv(path))


def export_single_file(df: DataFrame, file: str, sep: str = "|", single: bool = True) -> list[str]:
    """Delimited text under a chosen file name, or, if not ``single``, numbered siblings of it.

    Files that an earlier export left under the name or as its siblings go.
    """
    spark = df.sparkSession
    staged = f"{file}.parts"
    export_delimited(df, staged, sep=sep, single=single)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source = hadoop.Path(staged)
    store = source.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().getName() for s in store.listStatus(source) if s.getPath().getName().startswith("part-"))
    stem, dot, ending = file.rpartition(".")
    for old in [hadoop.Path(file), *[s.getPath() for s in store.globStatus(hadoop.Path(f"{stem}-[0-9][0-9][0-9][0-9][0-9]{dot}{ending}"))]]:
        store.delete(old, False)
    names = [file] if single else [f"{stem}-{i:05d}{dot}{ending}" for i in range(len(parts))]
    for part, name in zip(parts, names):
        if not store.rename(hadoop.Path(source, part), hadoop.Path(name)):
            raise OSError(f"{part} could not be renamed to {name}; the export stays in {staged}")
    store.delete(source, True)
    return names


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines; keys whose value is NULL are left out."""
    df.write.mode("overwrite").json(path)


def export_xml(df: DataFrame, path: str, row_tag: str, root_tag: str) -> None:
    """XML with the given tags; NULL nodes are left out."""
    df.write.mode("overwrite").format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)
