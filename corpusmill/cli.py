"""Command line: python -m corpusmill.cli --root DIR STAGE. Each stage reads and writes tables below the root."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.functions import text as X
from corpusmill.operators import build, collect, extract, freshness, index, master, packs, signing
from corpusmill.session import session
from corpusmill.sources import fetch, files, publishers, state

STATE = "_state"
FOLDERS = {"EHS": "publications", "OSHA-Interpretations": "interpretations", "OSHA-Directives": "directives", "CFR-29": "cfr", "CFR-49": "cfr", "EPA": "epa", "NFPA": "nfpa_ibr", "NFPA-Public": "nfpa_public"}


def say(value) -> None:
    print(json.dumps(value, indent=1, ensure_ascii=False, default=str))


def latest(spark, texts: str):
    """The last extraction of each file."""
    rows = spark.read.parquet(texts)
    return rows.groupBy("relative_path").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "relative_path"]), "modified").alias("r")).select("relative_path", "r.*")


def run_collect(spark, a) -> dict:
    """Regulations by the API, the other publishers by crawls that go on where they were stopped. --source names one; another --date begins the crawls anew."""
    titles, done = {"cfr-29": 29, "cfr-49": 49}, {}
    for name in (*publishers.PUBLISHERS, *titles):
        if a.source not in ("all", name):
            continue
        if name in titles:
            corpus = collect.TITLES[titles[name]][0]
            done[name] = regulations(spark, a.root, titles[name], corpus)
        else:
            corpus = publishers.PUBLISHERS[name].corpus
            done[name] = publishers.collected(spark, name, a.root, f"{a.root}/{STATE}/crawl/{name}/{a.date or 'first'}", lambda urls: fetch.fetch(urls), lambda plan, folder: fetch.download(plan, folder))
        state.record_capture(spark, f"{a.root}/{STATE}", corpus, date.today().isoformat())
    return done


def regulations(spark, root: str, title: int, corpus: str) -> dict:
    made = collect.collect_title(spark, title, lambda urls: fetch.fetch(urls))
    made.write.mode("overwrite").parquet(f"{root}/{STATE}/regulations/{corpus}")
    rows = spark.read.parquet(f"{root}/{STATE}/regulations/{corpus}")
    files.write_texts(rows.select(F.col("relative_path").alias("path"), "text"), f"{root}/{corpus}")
    listed = rows.withColumn("publisher", F.lit(master.PRINTING)).withColumn("bytes", F.octet_length("text")).withColumn("sha256", F.sha2("text", 256))
    files.write_one_csv(listed.orderBy(X.natural_key(F.col("section"))).select(*schemas.MANIFESTS["cfr"].split()), f"{root}/{corpus}/manifest.csv")
    return {"files": rows.count()}


def run_extract(spark, a) -> dict:
    docs, texts = files.documents(spark, a.root), f"{a.root}/{STATE}/text"
    if files.exists(spark, texts):
        done = spark.read.parquet(texts).select("relative_path", "modified", F.octet_length("text").alias("size"))
        docs = extract.up_to_date(docs, done).filter("not current").drop("current")
    found = extract.extract(docs).join(docs.select("relative_path", "modified"), "relative_path")
    found = found.withColumn("text", F.when(F.col("status") == "ok", extract.mirror_text(F.col("title"), F.col("body"))))
    found.drop("title", "body").write.mode("append").parquet(texts)
    extract.audit(latest(spark, texts)).write.mode("overwrite").parquet(f"{a.root}/{STATE}/audit")
    audited = spark.read.parquet(f"{a.root}/{STATE}/audit").orderBy("corpus", "relative_path")
    files.write_one_csv(audited, f"{a.root}/_EXTRACTION_AUDIT.csv")
    wanted = [r.relative_path for r in extract.ocr_candidates(audited).select("relative_path").toLocalIterator()]
    state.save(spark, f"{a.root}/{STATE}/ocr_candidates.json", wanted)
    return {r.status: r["count"] for r in audited.groupBy("status").count().collect()}


def run_ocr(spark, a) -> dict:
    """Reads the audit's PDFs without a text layer as images, and adds their texts to the mirror."""
    missing = extract.missing_tools()
    if missing:
        return {"error": f"not installed: {', '.join(missing)}"}
    texts, docs = f"{a.root}/{STATE}/text", files.documents(spark, a.root)
    sources = extract.ocr_sources(spark.read.parquet(f"{a.root}/{STATE}/audit"), docs, latest(spark, texts))
    extract.ocr(sources, extract.tesseract).write.mode("overwrite").parquet(f"{a.root}/{STATE}/ocr")
    found = spark.read.parquet(f"{a.root}/{STATE}/ocr")
    files.write_one_csv(found.drop("text").orderBy("relative_path"), f"{a.root}/{STATE}/ocr_results.csv")
    read = docs.select("corpus", "relative_path", "size").join(found.filter("status = 'ok'"), "relative_path")
    have = spark.read.parquet(texts)
    columns = {"modified": F.current_timestamp(), "note": F.lit("OCR")}
    read.select(*[columns.get(c, F.col(c)).cast(have.schema[c].dataType).alias(c) for c in have.columns]).write.mode("append").parquet(texts)
    return {r.status: r["count"] for r in found.groupBy("status").count().collect()}


def run_index(spark, a) -> dict:
    rows = latest(spark, f"{a.root}/{STATE}/text").filter("status = 'ok'")
    ext = extract.extension(F.col("relative_path"))
    rows = rows.select(F.concat(F.lit(f"{files.MIRROR}/"), X.mirror_path(F.col("relative_path"))).alias("text_path"), "corpus", ext.alias("source_format"), "text", F.regexp_replace("relative_path", r"\A[^/]*/", "").alias("source_path"))
    index.embed_index(index.described(rows, keep=("source_path",))).write.mode("overwrite").parquet(f"{a.root}/{STATE}/index")
    built = spark.read.parquet(f"{a.root}/{STATE}/index")
    files.write_one_csv(index.in_order(built.drop("source_path")), f"{a.root}/_TEXT_DEDUPE.csv")
    everything = master.from_manifests({f: files.manifest(spark, a.root, f, kind) for f, kind in FOLDERS.items()})
    everything.write.mode("overwrite").parquet(f"{a.root}/{STATE}/master")
    listed = spark.read.parquet(f"{a.root}/{STATE}/master")
    files.write_one_csv(listed.orderBy("corpus", "relative_path"), f"{a.root}/MASTER-INDEX.csv")
    counted = {r.corpus: r.rows for r in master.by_corpus(listed).orderBy("corpus").collect()}
    return {"index": index.storage(built).first().asDict(), "master": master.totals(listed).first().asDict() | {"by_corpus": counted} | master.reconcile(listed, files.documents(spark, a.root)).first().asDict()}


def run_build(spark, a) -> dict:
    """Packs of the specs in --specs, or of --only one, from the index, the manifests and the extracted texts, into --dist."""
    rows = latest(spark, f"{a.root}/{STATE}/text").filter("status = 'ok'")
    texts = rows.select(F.concat(F.lit(f"{files.MIRROR}/"), X.mirror_path(F.col("relative_path"))).alias("text_path"), "text")
    manifests = [files.manifest(spark, a.root, f, kind, last=True).withColumn("corpus", F.lit(f)) for f, kind in FOLDERS.items()]
    listed = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), manifests)
    held = packs.pack_files(spark.read.parquet(f"{a.root}/{STATE}/index"), listed)
    made = build.build(files.specs(spark, a.specs), held, texts, state.captures(spark, f"{a.root}/{STATE}"), a.dist, a.only, a.version, a.captured)
    found = [{k: v for k, v in r.asDict().items() if v is not None} for r in made.orderBy("kind", "pack_id").collect()]
    state.save(spark, f"{a.dist}/build-results.json", found)
    return {"packs": found}


def run_catalog(spark, a) -> dict:
    rows = packs.catalog(files.artifacts(spark, a.dist), a.release_base)
    Path(a.dist, "packs.json").write_text(packs.catalog_json(rows), encoding="utf-8")
    return packs.kinds(rows).first().asDict()


def run_sign(spark, a) -> dict:
    return {"signature": signing.sign_file(spark, Path(a.dist, "packs.json"), a.key)}


def run_verify(spark, a) -> dict:
    return signing.verify_folder(spark, a.dist, a.public_key)


def run_keygen(spark, a) -> dict:
    return {"public_key": signing.keygen(spark, a.key)}


def run_status(spark, a) -> dict:
    """What there is: files of each corpus and whether it has a manifest, the written tables, captures, and what is due."""
    counted = {r.corpus: r["count"] for r in files.documents(spark, a.root).groupBy("corpus").count().collect()}
    corpora = {c: {"files": n, "manifest": files.exists(spark, f"{a.root}/{c}/manifest.csv")} for c, n in sorted(counted.items()) if not c.startswith("_")}
    tables = {t: files.exists(spark, f"{a.root}/{t}") for t in ("_EXTRACTION_AUDIT.csv", "_TEXT_DEDUPE.csv", "MASTER-INDEX.csv")}
    captured = state.load(spark, f"{a.root}/{STATE}/captures.json", {})
    return {"root": a.root, "corpora": corpora, **tables, "captures": captured, "freshness_due": due(spark, a) if a.specs else []}


def due(spark, a) -> list[str]:
    specs = files.specs(spark, a.specs).withColumn("cadence_days", F.col("refresh.cadence_days"))
    return [r.pack_id for r in freshness.due(specs, state.checks(spark, f"{a.root}/{STATE}").withColumn("checked_at", F.to_timestamp("checked_at")), F.current_timestamp()).orderBy("pack_id").collect()]


def run_check(spark, a) -> dict:
    """Checks one pack (--pack), or all that are due (--due), and records the reports. --listing holds what the publisher lists, a line each; --date its date."""
    wanted = due(spark, a) if a.due else [a.pack] if a.pack else []
    captured = state.load(spark, f"{a.root}/{STATE}/captures.json", {})
    current = spark.read.text(a.listing).select(F.col("value").alias("key")) if a.listing else None
    plan = freshness.plan(spark.createDataFrame([(p,) for p in wanted], "pack_id string"), files.specs(spark, a.specs)).collect()
    out = []
    for r in sorted(plan, key=lambda r: r.pack_id):
        folder = freshness.compared(r.pack_id)
        listed = files.manifest(spark, a.root, folder, FOLDERS[folder]) if folder else spark.createDataFrame([], "source_url string, identifier string")
        row = freshness.checked(r.pack_id, r.method, r.detail, current, listed, captured.get(folder, ""), a.date).first().asDict()
        state.save(spark, f"{a.root}/{STATE}/freshness_{r.pack_id}.json", row)
        out.append(row)
    return {"checks": out} if out else {"due": []}


STAGES = {n[4:]: f for n, f in list(globals().items()) if n.startswith("run_")}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="corpusmill")
    p.add_argument("--root", default=".")
    p.add_argument("stage", choices=sorted(STAGES))
    for flag in ("--dist", "--release-base", "--key", "--public-key", "--listing", "--specs", "--only", "--version", "--captured", "--source", "--pack", "--date"):
        p.add_argument(flag, default={"--dist": "dist", "--release-base": "", "--source": "all"}.get(flag))
    p.add_argument("--due", action="store_true")
    a = p.parse_args(argv)
    try:
        found = STAGES[a.stage](session(), a)
    except signing.SignatureError as e:
        say({"error": str(e)})
        return 1
    say(found)
    return 1 if a.stage == "verify" and found["mismatched"] else 0


if __name__ == "__main__":
    sys.exit(main())
