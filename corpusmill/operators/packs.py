"""Content packs: their files with provenance, manifests, artifacts and the catalog."""

from __future__ import annotations

import hashlib
import io
import itertools
import json
import tarfile

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.sources import streams

#: zstd level of an artifact
LEVEL = 10
IDENTIFIERS = ("publication_id", "citation", "directive_number", "standards_cited", "section", "category")

#: Written names of members that are whole corpora, and the corpora they hold.
MEMBER_TITLES = {
    "cfr-29": "29 CFR - Occupational Safety and Health Standards",
    "osha-interpretations": "OSHA - Letters of Interpretation",
    "osha-directives": "OSHA - Enforcement Directives (CPL)",
    "osha-publications": "OSHA - Publications and Guidance",
}
MEMBER_CORPUS = {"cfr-29": "CFR-29", "osha-interpretations": "OSHA-Interpretations", "osha-directives": "OSHA-Directives", "osha-publications": "EHS"}


def member_title(pack_id: Column) -> Column:
    known = F.create_map(*[F.lit(x) for p in MEMBER_TITLES.items() for x in p])
    return F.coalesce(F.try_element_at(known, pack_id), X.human_name(pack_id))


def pack_files(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """The embedded rows of an index as pack files, joined with their manifest rows (corpus, relative_path, ...) on the source they came from.

    index has text_path, corpus, chars, embed and source_path (the source's path within its corpus).
    Missing provenance is empty; language is English where the manifest has none.
    """
    have = set(manifest.columns)
    of = lambda c: F.col("m." + c) if c in have else F.lit(None).cast("string")
    rows = index.filter(F.col("embed") == "yes").alias("i").join(manifest.alias("m"), (F.col("i.corpus") == F.col("m.corpus")) & (F.col("i.source_path") == F.col("m.relative_path")), "left")
    inner = F.regexp_replace(F.col("i.text_path"), r"\A[^/]*/[^/]*/", "")
    language = F.when(F.col("m.relative_path").isNull() | F.lit("language" not in have), "English").otherwise(F.coalesce(of("language"), F.lit("")))
    return rows.select(
        F.col("i.corpus").alias("corpus"),
        F.concat(F.lit("text/"), inner).alias("path"),
        F.concat_ws("/", F.col("i.corpus"), F.col("i.source_path")).alias("source_path"),
        F.coalesce(of("source_url"), F.lit("")).alias("source_url"),
        F.coalesce(of("sha256"), F.lit("")).alias("source_sha256"),
        X.first_filled(of("title"), of("subject")).alias("title"),
        X.first_filled(*map(of, IDENTIFIERS)).alias("identifier"),
        language.alias("language"),
        F.col("i.chars").alias("chars"),
        F.col("i.text_path").alias("text_path"),
    )


def planned(files: DataFrame, plan: DataFrame) -> DataFrame:
    """Every file with its pack, in one pass: plan has corpus, section (null: the whole corpus) and pack_id, and is small by nature (a row a pack)."""
    rows = files.withColumn("section", F.get(F.split(F.regexp_replace("path", r"\Atext/", ""), "/"), F.lit(0)))
    p = plan.alias("p")
    return rows.alias("f").join(p, (F.col("f.corpus") == F.col("p.corpus")) & (F.col("p.section").isNull() | (F.col("f.section") == F.col("p.section")))).select("f.*", "p.pack_id")


def sections_plan(files: DataFrame, corpus: str, template: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """A plan row for each section of a corpus; template holds {section}."""
    section = F.get(F.split(F.regexp_replace("path", r"\Atext/", ""), "/"), F.lit(0))
    found = files.filter(F.col("corpus") == corpus).select("corpus", section.alias("section")).distinct()
    if excluded:
        found = found.filter(~F.col("section").isin(*excluded))
    return found.withColumn("pack_id", F.replace(F.lit(template), F.lit("{section}"), F.col("section")))


def manifests(files: DataFrame) -> DataFrame:
    """doc_count and text_bytes of each pack; its files stay rows, however many it has."""
    return files.groupBy("pack_id").agg(F.count("*").alias("doc_count"), F.sum("chars").alias("text_bytes"), F.min("path").alias("first_path"))


def meta(members: DataFrame) -> DataFrame:
    """Meta packs of members (pack_id, ord, member, captured_at, built): the newest capture, the version, the members in order, and those not built. A bundle has as many members as its spec lists, or as a corpus has sections: tens."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("ord", "member")))), lambda x: x["member"])
    return members.groupBy("pack_id").agg(F.max("captured_at").alias("captured_at"), ordered(F.lit(True)).alias("members"), ordered(~F.col("built")).alias("missing_members")).withColumn("version", X.version(F.col("captured_at")))


def captured(corpora: DataFrame, captures: DataFrame, override: str | None = None) -> DataFrame:
    """corpora (corpus) with captured_at: the override, the recorded capture, or today."""
    return corpora.join(captures.select("corpus", F.col("captured_at").alias("_c")), "corpus", "left").withColumn("captured_at", F.coalesce(F.lit(override), X.blank_to_null(F.col("_c")), F.date_format(F.current_date(), "yyyy-MM-dd"))).drop("_c")


def write_artifacts(texts: DataFrame, packs: DataFrame, folder: str, entries: DataFrame | None = None) -> DataFrame:
    """(pack_id, artifact, sha256, bytes): one tar.zst a pack, streamed in path order, manifest first, with its .sha256 beside it.

    texts: pack_id, path, text.  packs: pack_id, version, manifest (JSON), and, where its list of files is left out,
    rest (what follows the list) and manifest_bytes (the whole manifest's).  entries: pack_id, path, entry, what the
    list holds.  A pack's rows are streamed through one task, a text or an entry at a time; nothing of a pack but
    its compressed output is held, and the archive's dates and owners are fixed, so equal inputs give equal
    bytes.  folder must be one that all executors share.
    """
    null = lambda kind: F.lit(None).cast(kind)
    more = [c if c in packs.columns else null(t).alias(c) for c, t in (("rest", "string"), ("manifest_bytes", "long"))]
    rows = packs.select("pack_id", F.lit(_HEAD).alias("kind"), null("string").alias("path"), F.col("manifest").alias("text"), "version", *more)
    if entries is not None:
        rows = rows.unionByName(entries.select("pack_id", F.lit(_ENTRY).alias("kind"), "path", F.col("entry").alias("text")), allowMissingColumns=True)
    rows = rows.unionByName(texts.select("pack_id", F.lit(_TEXT).alias("kind"), "path", "text"), allowMissingColumns=True)
    rows = rows.repartition("pack_id").sortWithinPartitions("pack_id", "kind", "path")

    def write(batches):
        rows = (r for batch in batches for r in batch.to_pylist())
        for pack_id, own in itertools.groupby(rows, key=lambda r: r["pack_id"]):
            made = _Artifact(pack_id, folder)
            for kind, part in itertools.groupby(own, key=lambda r: r["kind"]):
                if kind == _HEAD:
                    made.begin(next(part))
                elif kind == _ENTRY:
                    made.listing(r["text"] for r in part)
                else:
                    for r in part:
                        made.add(r["path"], r["text"] or "")
            yield pa.RecordBatch.from_pylist([made.close()], pa.schema([("pack_id", pa.string()), ("artifact", pa.string()), ("sha256", pa.string()), ("bytes", pa.int64())]))

    return rows.mapInArrow(write, "pack_id string, artifact string, sha256 string, bytes long")


#: kinds of a pack's rows, in their order
_HEAD, _ENTRY, _TEXT = 0, 1, 2


class _Flow(io.RawIOBase):
    """Bytes as a file to read once."""

    def __init__(self, parts):
        self.parts, self.held = iter(parts), b""

    def read(self, n: int = -1) -> bytes:
        while len(self.held) < n:
            more = next(self.parts, None)
            if more is None:
                break
            self.held += more
        out, self.held = self.held[:n], self.held[n:]
        return out


class _Artifact:
    def __init__(self, pack_id: str, folder: str):
        self.pack_id, self.folder, self.head = pack_id, folder, None

    def begin(self, head: dict) -> None:
        import os

        self.name = f"{self.pack_id}-{head['version']}.tar.zst"
        os.makedirs(self.folder, exist_ok=True)
        self.path, self.part = os.path.join(self.folder, self.name), os.path.join(self.folder, f".{self.name}.{os.getpid()}.part")
        self.raw = open(self.part, "wb")  # noqa: SIM115
        self.packed = zstandard.ZstdCompressor(level=LEVEL).stream_writer(self.raw, closefd=False)
        self.tar = tarfile.open(fileobj=self.packed, mode="w|")
        self.head = head
        if head["manifest_bytes"] is None:
            self.add("manifest.json", head["text"] or "{}")

    def listing(self, entries) -> None:
        """The manifest with its list of files, an entry at a time."""
        commas = (("," if i else "") + e for i, e in enumerate(entries))
        entry = tarfile.TarInfo("manifest.json")
        entry.size = self.head["manifest_bytes"]
        self.tar.addfile(entry, _Flow(x.encode() for x in itertools.chain([self.head["text"]], commas, [self.head["rest"]])))

    def add(self, name: str, text: str) -> None:
        data = text.encode()
        entry = tarfile.TarInfo(name)
        entry.size = len(data)
        self.tar.addfile(entry, io.BytesIO(data))

    def close(self) -> dict:
        import os

        self.tar.close()
        self.packed.close()
        self.raw.close()
        digest = hashlib.sha256()
        with open(self.part, "rb") as f:
            for block in iter(lambda: f.read(1 << 20), b""):
                digest.update(block)
        size = os.path.getsize(self.part)
        os.replace(self.part, self.path)
        with open(self.path + ".sha256", "w") as f:
            f.write(f"{digest.hexdigest()}  {self.name}\n")
        return {"pack_id": self.pack_id, "artifact": self.name, "sha256": digest.hexdigest(), "bytes": size}


MANIFEST = (
    "pack_id string, kind string, version string, title string, publisher string, rights_tier string, rights_note string, corpus string, section string, captured_at string, "
    "refresh map<string,string>, query_expansion map<string,array<string>>, doc_count long, text_bytes long, members array<string>, required_members array<string>, recommends array<string>, description string"
)


def catalog(artifacts: DataFrame, release_base: str = "", latest: bool = False) -> DataFrame:
    """Catalog rows of artifacts (artifact, place), which are read on the executors a block at a time; all versions, or each pack's latest."""
    rows = streams.facts(artifacts).filter("manifest is not null").select("artifact", F.col("found_bytes").alias("artifact_bytes"), F.col("found_sha256").alias("artifact_sha256"), "manifest")
    rows = rows.withColumn("m", F.from_json("manifest", MANIFEST)).select("artifact", "artifact_bytes", "artifact_sha256", "m.*")
    rows = entries(rows, release_base)
    if latest:
        rows = rows.groupBy("pack_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "pack_id"]), F.struct("version", "artifact")).alias("r")).select("pack_id", "r.*")
    return rows.orderBy("artifact")


def entries(rows: DataFrame, release_base: str = "") -> DataFrame:
    """rows with the address of their artifact, empty without a base."""
    base = release_base.rstrip("/")
    return rows.withColumn("url", F.concat(F.lit(base + "/"), F.col("artifact")) if base else F.lit(""))


def kinds(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("packs"), F.count_if(F.col("kind") == "content").alias("content"), F.count_if(F.col("kind") == "meta").alias("meta"))


def catalog_json(rows: DataFrame) -> str:
    """packs.json of a catalog (a row an artifact, tens of rows)."""
    common = ("pack_id", "kind", "version", "title", "publisher", "rights_tier", "rights_note", "captured_at", "refresh", "artifact", "artifact_bytes", "artifact_sha256", "url")
    own = {"content": ("doc_count", "text_bytes", "corpus", "section"), "meta": ("members", "required_members", "recommends", "description")}
    packs = [{k: d[k] for k in (*common, *own.get(d["kind"], ())) if k in d} for d in (r.asDict(True) for r in rows.orderBy("artifact").collect())]
    return json.dumps({"schema": 1, "packs": packs}, indent=1, ensure_ascii=False) + "\n"


def verified(catalog_rows: DataFrame, files: DataFrame) -> DataFrame:
    """(artifact, status) of catalog rows against files (artifact, place), hashed where they lie, or (artifact, content): verified, mismatched or absent."""
    if "content" in files.columns:
        have = files.select("artifact", F.sha2("content", 256).alias("found"))
    else:
        listed = files.join(catalog_rows.select("artifact").distinct(), "artifact", "left_semi")
        have = streams.facts(listed, manifests=False).select("artifact", F.col("found_sha256").alias("found"))
    status = F.when(F.col("found").isNull(), "absent").when(F.col("found") == F.col("artifact_sha256"), "verified").otherwise("mismatched")
    return catalog_rows.select("artifact", "artifact_sha256").join(have, "artifact", "left").select("artifact", status.alias("status"))
