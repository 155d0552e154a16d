"""The jobs: the same result on every run, only what is new, and whole after a failure."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import index
from jobs import common
from jobs.corpus_build import SETTINGS, corpus_build
from jobs.index_updates import index_updates

LONG = "a text that is long enough to be compared with the texts of other documents, number "
ROWS = [(1, LONG + "1", "a"), (22, LONG + "1", "b"), (3, LONG + "1", "sheet"), (4, "short", "a"), (5, None, "a"), (None, LONG + "5", None), (7, LONG + "  7 \n\n\n\n x", ""), (8, LONG + "8", "x/y=z"), (8, LONG + "8", "x/y=z")]
MORE = [(2, LONG + "1", "a"), (9, LONG + "5", "b"), (10, LONG + "10", "c")]


def documents(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "doc_id long, text string, source string, embed string, batch int")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def whole(spark, given):
    return rows(index.embed_index(index.described(common.mirror(documents(spark, given)))))


def test_corpus_build(spark, tmp_path):
    at, out = f"{tmp_path}/documents.parquet", f"{tmp_path}/out"
    documents(spark, ROWS + MORE).write.parquet(at)
    first = rows(corpus_build(spark, at, out, formats={"sheet": ".xlsx"}))
    assert first == rows(corpus_build(spark, at, out, formats={"sheet": ".xlsx"})) and len(first) == len(ROWS + MORE)
    found = {r.text_path: r for r in corpus_build(spark, at, out, formats={"sheet": ".xlsx"}).collect()}
    assert found["_TEXT/a/1.txt"].text_sha256 and found["_TEXT/a/2.txt"].duplicate_of == "_TEXT/a/1.txt"
    assert found["_TEXT/sheet/3.txt"].exclude_reason == "bulk-data-spreadsheet" and found["_TEXT/a/5.txt"].exclude_reason == "too-short"
    assert found["_TEXT/unknown/null.txt"].corpus_files == 2
    text = spark.read.parquet(f"{out}/embedded").filter("text_path = '_TEXT/unknown/7.txt'").first().text
    assert text == LONG + "7\n\nx"
    # nothing of documents that are gone stays
    documents(spark, ROWS[:1]).write.mode("overwrite").parquet(at)
    assert [r.text_path for r in corpus_build(spark, at, out).collect()] == ["_TEXT/a/1.txt"]
    documents(spark, []).write.mode("overwrite").parquet(at)
    assert corpus_build(spark, at, out).collect() == []


def test_index_grows_with_its_documents(spark, tmp_path, caplog):
    at, out, mark = f"{tmp_path}/documents.parquet", f"{tmp_path}/out", f"{tmp_path}/mark"
    documents(spark, ROWS).repartition(3).write.parquet(at)
    assert rows(index_updates(spark, at, out, mark, files_per_batch=2)) == whole(spark, ROWS)
    caplog.set_level("INFO")
    documents(spark, MORE).coalesce(1).write.mode("append").parquet(at)
    assert rows(index_updates(spark, at, out, mark)) == whole(spark, ROWS + MORE)
    assert f"read {len(MORE)} new documents" in caplog.text
    caplog.clear()
    before = {p.name for p in Path(out, "rows").iterdir()}
    assert rows(index_updates(spark, at, out, mark)) == whole(spark, ROWS + MORE)
    assert "read 0 new documents" in caplog.text and {p.name for p in Path(out, "rows").iterdir()} == before


def test_index_after_a_failure(spark, tmp_path, monkeypatch):
    """A run that ends after a batch was written but before it counts as done leaves nothing twice and nothing out."""
    at, out, mark = f"{tmp_path}/documents.parquet", f"{tmp_path}/out", f"{tmp_path}/mark"
    documents(spark, ROWS + MORE).repartition(4).write.parquet(at)
    said = common.log.info

    def fails(text, *of):
        said(text, *of)
        if text.startswith("batch") and of[0] == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(common.log, "info", fails)
    with pytest.raises(Exception, match="lost"):
        index_updates(spark, at, out, mark, files_per_batch=1)
    monkeypatch.undo()
    assert rows(index_updates(spark, at, out, mark, files_per_batch=3)) == whole(spark, ROWS + MORE)


def test_index_of_one_file_and_of_none(spark, tmp_path):
    at = f"{tmp_path}/parts"
    documents(spark, ROWS).coalesce(1).write.parquet(at)
    (file,) = Path(at).glob("*.parquet")
    assert rows(index_updates(spark, str(file), f"{tmp_path}/out", f"{tmp_path}/mark")) == whole(spark, ROWS)
    (tmp_path / "nothing").mkdir()
    assert index_updates(spark, f"{tmp_path}/nothing", f"{tmp_path}/out2", f"{tmp_path}/mark2").collect() == []


def test_settings(spark, tmp_path):
    at = tmp_path / "settings.json"
    at.write_text(json.dumps({"formats": {"a": ".pdf"}}, indent=1))
    assert common.settings(spark, str(at), SETTINGS) == {"formats": {"a": ".pdf"}, "rank_after_exclusion": False}
    at.write_text('{"formatz": {}}')
    with pytest.raises(ValueError, match="formatz"):
        common.settings(spark, str(at), SETTINGS)


def test_command_line(spark, tmp_path):
    at = f"{tmp_path}/documents.parquet"
    documents(spark, ROWS).write.parquet(at)
    done = subprocess.run([sys.executable, "-m", "jobs.index_updates", "--documents", at, "--output", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/mark"], capture_output=True, text=True, cwd=Path(__file__).parents[1], timeout=300, check=True)
    assert f"read {len(ROWS)} new documents" in done.stderr
    assert spark.read.parquet(f"{tmp_path}/out/index").count() == len(ROWS)
    assert spark.read.parquet(f"{tmp_path}/out/index").filter(F.col("embed") == "yes").count() == 5
