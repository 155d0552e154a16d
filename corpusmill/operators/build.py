"""From specs to packs: which packs there are, their manifests, and their artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import packs

_ENTRY = ("path", "source_path", "source_url", "source_sha256", "title", "identifier", "language", "chars")


def member_corpus(pack_id: Column) -> Column:
    """The corpus that a member of a written list holds."""
    return F.try_element_at(F.create_map(*[F.lit(x) for p in packs.MEMBER_CORPUS.items() for x in p]), pack_id)


def _section(path: str = "path") -> Column:
    return F.get(F.split(F.regexp_replace(path, r"\Atext/", ""), "/"), F.lit(0))


def contents(specs: DataFrame, files: DataFrame, captures: DataFrame, version: str | None = None, captured: str | None = None) -> DataFrame:
    """A row a content pack that the specs ask for: pack_id, spec_id, pos, corpus, section, title, captured_at, version.

    A content spec is one pack.  A meta spec has a pack for each of its members: those it lists, or one for
    each section of a corpus's files but the excluded ones.  Each is as current as its own corpus.
    """
    none = F.lit(None).cast("string")
    own = specs.filter("kind = 'content'").select("pack_id", F.col("pack_id").alias("spec_id"), F.lit(0).alias("pos"), "corpus", none.alias("section"), F.coalesce("title", "pack_id").alias("title"))
    listed = specs.filter("kind = 'meta' AND members_from IS NULL").select(F.col("pack_id").alias("spec_id"), F.posexplode("members").alias("pos", "pack_id"))
    listed = listed.select("pack_id", "spec_id", "pos", member_corpus(F.col("pack_id")).alias("corpus"), none.alias("section"), packs.member_title(F.col("pack_id")).alias("title"))
    split = specs.filter("kind = 'meta' AND members_from IS NOT NULL").select(F.col("pack_id").alias("spec_id"), "members_from.*", F.coalesce(X.blank_to_null(F.col("short_title")), "title").alias("stem"))
    sections = files.select("corpus", _section().alias("section")).distinct()
    split = split.join(sections, "corpus").filter(~F.coalesce(F.array_contains("exclude_sections", F.col("section")), F.lit(False)))
    name = F.concat("stem", F.lit(" - "), X.human_name(F.col("section")))
    split = split.select(F.replace("member_id", F.lit("{section}"), F.col("section")).alias("pack_id"), "spec_id", F.lit(0).alias("pos"), "corpus", "section", name.alias("title"))
    rows = own.unionByName(listed).unionByName(split)
    dates = packs.captured(rows.select("corpus").distinct(), captures, captured)
    rows = rows.join(F.broadcast(dates), "corpus")  # a row a corpus of the specs
    return rows.withColumn("version", F.coalesce(F.lit(version), X.version(F.col("captured_at")))).select("pack_id", "spec_id", "pos", "corpus", "section", "title", "captured_at", "version")


def metas(specs: DataFrame, plan: DataFrame, version: str | None = None) -> DataFrame:
    """A row a meta spec: pack_id, members in order (by place, then by section), the newest capture of its members, version. Members are as few as the specs say, or a corpus has sections."""
    found = plan.groupBy("spec_id").agg(F.max("captured_at").alias("captured_at"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "section", "pack_id"))), lambda x: x["pack_id"]).alias("found"))
    rows = specs.filter("kind = 'meta'").join(found, F.col("pack_id") == F.col("spec_id"), "left")
    today = F.date_format(F.current_date(), "yyyy-MM-dd")
    rows = rows.withColumn("captured_at", F.coalesce("captured_at", today)).withColumn("members", F.coalesce("found", F.array().cast("array<string>")))
    return rows.withColumn("version", F.coalesce(F.lit(version), X.version(F.col("captured_at")))).drop("spec_id", "found")


def assigned(files: DataFrame, plan: DataFrame) -> DataFrame:
    """files with the pack_id of each pack that takes them."""
    return packs.planned(files, plan.select("corpus", F.col("section"), "pack_id"))


def _json(*parts) -> Column:
    """The text of a JSON object of (name, column) pairs; nulls within values are left out, as in the specs."""
    bare = lambda c: F.regexp_extract(F.to_json(F.array(c), {"ignoreNullFields": "true"}), r"(?s)\A\[(.*)\]\z", 1)
    fields = [F.concat(F.lit(f'"{name}":'), F.when(c.isNull(), "null").otherwise(bare(c))) for name, c in parts]
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def content_manifests(specs: DataFrame, plan: DataFrame, files: DataFrame) -> DataFrame:
    """A row a content pack with files (assigned ones): its facts, its manifest's JSON up to the list of files, what follows the list, and the whole manifest's bytes.

    The list itself stays a table of entries(): it is as long as the pack has files, and is streamed into the artifact.
    """
    listed = entries(files).groupBy("pack_id").agg(F.count("*").alias("doc_count"), F.sum("chars").alias("text_bytes"), (F.sum(F.octet_length("entry")) + F.count("*") - 1).alias("list_bytes"))
    kept = specs.select(F.col("pack_id").alias("spec_id"), "publisher", "rights_tier", F.coalesce("rights_note", F.lit("")).alias("rights_note"), "refresh", "query_expansion")
    rows = plan.join(listed, "pack_id").join(F.broadcast(kept), "spec_id")
    empty = F.lit("{}")
    refresh, words = (F.coalesce(F.to_json(c), empty) for c in ("refresh", "query_expansion"))
    col = F.col
    head = _json(("pack_id", col("pack_id")), ("kind", F.lit("content")), ("version", col("version")), ("title", col("title")), ("publisher", col("publisher")), ("rights_tier", col("rights_tier")), ("rights_note", col("rights_note")), ("corpus", col("corpus")), ("section", col("section")), ("captured_at", col("captured_at")), ("doc_count", col("doc_count")), ("text_bytes", col("text_bytes")))
    head = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"refresh":'), refresh, F.lit(',"query_expansion":'), words, F.lit(',"files":['))
    rows = rows.withColumn("kind", F.lit("content")).withColumn("manifest", head).withColumn("rest", F.lit("]}"))
    return rows.withColumn("manifest_bytes", (F.octet_length("manifest") + F.col("list_bytes") + F.octet_length("rest")).cast("long")).drop("list_bytes", "pos")


def meta_manifests(metas: DataFrame) -> DataFrame:
    """metas with their manifests, which are whole."""
    col, none = F.col, F.array().cast("array<string>")
    head = _json(("pack_id", col("pack_id")), ("kind", F.lit("meta")), ("version", col("version")), ("title", col("title")), ("publisher", col("publisher")), ("rights_tier", col("rights_tier")), ("rights_note", F.coalesce("rights_note", F.lit(""))), ("captured_at", col("captured_at")), ("members", col("members")), ("required_members", F.coalesce("required_members", none)), ("recommends", F.coalesce("recommends", none)), ("description", F.coalesce("description", F.lit(""))))
    whole = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"refresh":'), F.coalesce(F.to_json("refresh"), F.lit("{}")), F.lit("}"))
    return metas.withColumn("kind", F.lit("meta")).withColumn("manifest", whole)


def entries(files: DataFrame) -> DataFrame:
    """(pack_id, path, entry, chars) of assigned files: entry is a file's place in a manifest as JSON."""
    return files.select("pack_id", "path", F.to_json(F.struct(*_ENTRY), {"ignoreNullFields": "false"}).alias("entry"), "chars")


def build(specs: DataFrame, files: DataFrame, texts: DataFrame, captures: DataFrame, folder: str, only: str | None = None, version: str | None = None, captured: str | None = None) -> DataFrame:
    """Every pack of the specs, or of the one named by only, written to folder: pack_id, kind, artifact, sha256, bytes, doc_count, text_bytes, members, skipped.

    files are pack files of all corpora, texts (text_path, text) the mirror.  A content pack without files is not
    written; its row says so.
    """
    specs = specs.filter(F.col("pack_id") == only) if only else specs
    plan = contents(specs, files, captures, version, captured)
    held = assigned(files, plan)
    content, meta = content_manifests(specs, plan, held), meta_manifests(metas(specs, plan, version))
    heads = content.select("pack_id", "version", "manifest", "rest", "manifest_bytes").unionByName(meta.select("pack_id", "version", "manifest"), allowMissingColumns=True)
    bodies = held.select("pack_id", "path", "text_path").join(texts.select("text_path", "text"), "text_path").select("pack_id", "path", "text")
    made = packs.write_artifacts(bodies, heads, folder, entries(held).select("pack_id", "path", "entry"))
    facts = plan.select("pack_id", F.lit("content").alias("kind")).join(content.select("pack_id", "doc_count", "text_bytes"), "pack_id", "left").unionByName(meta.select("pack_id", "kind", "members"), allowMissingColumns=True)
    skipped = F.when(F.col("artifact").isNull(), "no embed=yes text")
    return facts.join(made, "pack_id", "left").select("pack_id", "kind", "artifact", "sha256", "bytes", "doc_count", "text_bytes", "members", skipped.alias("skipped"))
