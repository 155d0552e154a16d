import base64
import itertools
import json
import os
import re
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.operators import freshness, packs, retrieval, signing
from corpusmill.sources import files, streams


def _index(spark):
    rows = [("_TEXT/EPA/lead/a.txt", "EPA", 10, "yes", "lead/a.pdf"), ("_TEXT/EPA/mold/b.txt", "EPA", 20, "yes", "mold/b.pdf"), ("_TEXT/EPA/mold/c.txt", "EPA", 5, "no", "mold/c.pdf"), ("_TEXT/CFR-29/s.txt", "CFR-29", 7, "yes", "s.txt")]
    return spark.createDataFrame(rows, "text_path string, corpus string, chars long, embed string, source_path string")


def _files(spark):
    man = spark.createDataFrame([("EPA", "lead/a.pdf", "http://a", "sha", "", "Subject", "lead", "")], "corpus string, relative_path string, source_url string, sha256 string, title string, subject string, section string, citation string")
    return packs.pack_files(_index(spark), man)


def test_pack_files(spark):
    by = {r.path: r for r in _files(spark).collect()}
    a, b = by["text/lead/a.txt"], by["text/mold/b.txt"]
    assert (a.source_path, a.source_url, a.title, a.identifier, a.language) == ("EPA/lead/a.pdf", "http://a", "Subject", "lead", "English")
    assert (b.source_url, b.title, b.identifier, b.language) == ("", "", "", "English") and len(by) == 3


def test_plan_and_manifests(spark):
    f = _files(spark)
    plan = packs.sections_plan(f, "EPA", "epa-{section}", ("none",)).unionByName(spark.createDataFrame([("CFR-29", None, "cfr-29")], "corpus string, section string, pack_id string"))
    got = {r.pack_id: (r.doc_count, r.text_bytes) for r in packs.manifests(packs.planned(f, plan)).collect()}
    assert got == {"epa-lead": (1, 10), "epa-mold": (1, 20), "cfr-29": (1, 7)}
    assert packs.sections_plan(f, "EPA", "epa-{section}", ("mold",)).count() == 1


def test_meta(spark):
    rows = spark.createDataFrame([("m", 2, "b", "2026-01-02", True), ("m", 1, "a", "2026-03-01", False)], "pack_id string, ord int, member string, captured_at string, built boolean")
    r = packs.meta(rows).first()
    assert (r.captured_at, r.version, r.members, r.missing_members) == ("2026-03-01", "2026.03.01", ["a", "b"], ["a"])


def test_captured(spark):
    corpora = spark.createDataFrame([("A",), ("B",)], "corpus string")
    caps = freshness.record(spark.createDataFrame([("A", "2020-01-01")], "corpus string, captured_at string"), "A", "2021-01-01")
    got = {r.corpus: r.captured_at for r in packs.captured(corpora, caps).collect()}
    assert got["A"] == "2021-01-01" and len(got["B"]) == 10
    assert {r.captured_at for r in packs.captured(corpora, caps, "1999-01-01").collect()} == {"1999-01-01"}


def test_member_title(spark):
    df = spark.createDataFrame([("cfr-29",), ("epa-lead",)], "p string")
    assert [r[0] for r in df.select(packs.member_title(F.col("p"))).collect()] == ["29 CFR - Occupational Safety and Health Standards", "EPA Lead"]


@pytest.fixture
def dist(spark, tmp_path):
    made = []
    for name, kind in (("content", "content"), ("bundle", "meta")):
        m = {"pack_id": name, "kind": kind, "version": "2026.01.02", "title": "Título", "publisher": "P", "rights_tier": "public-domain", "captured_at": "2026-01-02", "refresh": {"cadence_days": 7}}
        m |= {"doc_count": 2, "text_bytes": 9, "corpus": "C", "section": None, "files": []} if kind == "content" else {"members": ["content"]}
        made.append((name, "2026.01.02", json.dumps(m, ensure_ascii=False)))
    table = spark.createDataFrame(made, "pack_id string, version string, manifest string")
    texts = spark.createDataFrame([("content", "text/b.txt", "zwei"), ("content", "text/a.txt", "éins")], "pack_id string, path string, text string")
    written = {r.pack_id: r for r in packs.write_artifacts(texts, table, str(tmp_path)).collect()}
    return tmp_path, written, (texts, table)


def test_artifacts(spark, dist):
    folder, written, again = dist
    assert (folder / "content-2026.01.02.tar.zst.sha256").read_text() == f"{written['content'].sha256}  content-2026.01.02.tar.zst\n"
    import io
    import tarfile

    import zstandard

    with zstandard.ZstdDecompressor().stream_reader((folder / "content-2026.01.02.tar.zst").read_bytes()) as z, tarfile.open(fileobj=io.BytesIO(z.read())) as tar:
        assert tar.getnames() == ["manifest.json", "text/a.txt", "text/b.txt"] and tar.extractfile("text/a.txt").read().decode() == "éins"
    second = {r.pack_id: r.sha256 for r in packs.write_artifacts(*again, str(folder / "again")).collect()}
    assert second == {k: v.sha256 for k, v in written.items()}


def test_catalog(spark, dist):
    rows = packs.catalog(files.artifacts(spark, str(dist[0])), "https://r.example.org/v1/")
    data = json.loads(packs.catalog_json(rows))
    assert [p["pack_id"] for p in data["packs"]] == ["bundle", "content"] and data["schema"] == 1
    content = data["packs"][1]
    assert content["url"] == "https://r.example.org/v1/content-2026.01.02.tar.zst" and content["doc_count"] == 2 and "members" not in content and content["title"] == "Título"
    assert tuple(packs.kinds(rows).first()) == (2, 1, 1)
    assert packs.catalog(files.artifacts(spark, str(dist[0])), latest=True).count() == 2


SEED = bytes(range(32))


def test_signature_of_a_known_key(spark):
    """Signing is deterministic: the key of seed 0..31 and its signature verify, and no other bytes do."""
    public = signing.public_key(SEED)
    assert public == base64.b64encode(bytes.fromhex("03a107bff3ce10be1d70dd18e74bc09967e4d6309ba50d5f1ddc8664125531b8")).decode()
    line = signing.sign(spark, b"catalog", SEED)
    assert line == signing.sign(spark, b"catalog", SEED) and line.endswith("\n") and len(base64.b64decode(line)) == 64
    signing.verify(spark, b"catalog", line, public)
    for data, sig, key, said in ((b"other", line, public, "does not match"), (b"catalog", "", public, "not signed"), (b"catalog", "%%", public, "not base64"), (b"catalog", line, "AAAA", "32 bytes"), (b"catalog", line, "%", "not base64"), (b"catalog", line, signing.public_key(b"x" * 32), "does not match"), (b"catalog", base64.b64encode(b"short").decode(), public, "does not match")):
        with pytest.raises(signing.SignatureError, match=said):
            signing.verify(spark, data, sig, key)


def test_keys(spark, tmp_path):
    key = tmp_path / "k" / "key.pem"
    public = signing.keygen(spark, key)
    assert signing.public_key(signing.load(key)) == public and os.stat(key).st_mode & 0o77 == 0
    with pytest.raises(signing.SignatureError, match="overwrite"):
        signing.keygen(spark, key)
    (tmp_path / "repo" / ".git").mkdir(parents=True)
    with pytest.raises(signing.SignatureError, match="repository"):
        signing.keygen(spark, tmp_path / "repo" / "in" / "key.pem")
    (tmp_path / "bad").write_text("hello")
    with pytest.raises(signing.SignatureError, match="PEM"):
        signing.load(tmp_path / "bad")


def test_signed_folder(spark, dist, tmp_path_factory):
    folder, _, _ = dist
    key = tmp_path_factory.mktemp("keys") / "key.pem"
    public = signing.keygen(spark, key)
    (folder / "packs.json").write_text(packs.catalog_json(packs.catalog(files.artifacts(spark, str(folder)))), encoding="utf-8")
    with pytest.raises(signing.SignatureError, match="not signed"):
        signing.verify_folder(spark, folder, public)
    signing.sign_file(spark, folder / "packs.json", key)
    names = ["bundle-2026.01.02.tar.zst", "content-2026.01.02.tar.zst"]
    assert signing.verify_folder(spark, folder, public) == {"verified": names, "mismatched": [], "absent": []}
    (folder / names[0]).unlink()
    with open(folder / names[1], "ab") as f:
        f.write(b"x")
    assert signing.verify_folder(spark, folder, public) == {"verified": [], "mismatched": [names[1]], "absent": [names[0]]}
    out = subprocess.run([sys.executable, "-m", "corpusmill.cli", "verify", "--dist", str(folder), "--public-key", public], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=120)
    assert out.returncode == 1 and json.loads(out.stdout)["mismatched"] == [names[1]]
    (folder / "packs.json").write_text("{}")
    with pytest.raises(signing.SignatureError, match="does not match"):
        signing.verify_folder(spark, folder, public)


def test_freshness(spark):
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    r = freshness.difference(keys("a", "b", "c", "c"), keys("b", "z"), sample=1).first()
    assert tuple(r) == (True, 2, 1, ["a"], ["z"])
    assert tuple(freshness.difference(keys("b"), keys("b", "z"), only_added=True).first())[:3] == (False, 0, 1)
    assert tuple(freshness.difference(keys("b"), keys("b")).first()) == (False, 0, 0, [], [])
    assert freshness.harvest(None, keys("b")).first().stale is None and freshness.harvest(keys("q"), keys("b")).first().stale
    man = spark.createDataFrame([("http://a?x=1",), ("",), (None,)], "source_url string")
    assert [r.key for r in freshness.known_urls(man).collect()] == ["http://a"]
    d = spark.createDataFrame([("2026-02-01", "2026-01-31"), ("2026-01-31", "2026-01-31"), ("2026-02-01", ""), (None, "x")], "a string, b string")
    assert [r[0] for r in d.select(freshness.date_stale(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]


def test_due(spark):
    specs = spark.createDataFrame([("m", "meta", ["x", "y"], 7), ("c", "content", None, 30), ("n", "content", None, None)], "pack_id string, kind string, members array<string>, cadence_days int")
    checks = spark.createDataFrame([("x", datetime(2026, 1, 1)), ("c", datetime(2026, 1, 1)), ("y", datetime(2026, 1, 8, 0, 0, 1))], "pack_id string, checked_at timestamp")
    now = F.lit(datetime(2026, 1, 15))
    assert sorted(r.pack_id for r in freshness.due(specs, checks, now).collect()) == ["x"]
    assert sorted(r.pack_id for r in freshness.due(specs, checks.limit(0), now).collect()) == ["c", "x", "y"]
    own = {r.pack_id: r.owner for r in freshness.owners(specs).collect()}
    assert own["x"] == "m" and own["c"] == "c"


def test_expansion(spark):
    maps = spark.sql("select 'p' pack_id, map('nitro', array('Glyceryl'), 'how do i transfer', array('carriage', 'Transport'), 'transfer', array('transport', 'move')) query_expansion")
    q = spark.createDataFrame([(1, "How do I TRANSFER nitro?"), (2, "transfers"), (3, "Move and transfer it")], "question_id int, question string")
    got = {r.question_id: r.terms for r in retrieval.expand(q, retrieval.exploded(maps)).collect()}
    assert got == {1: ["carriage", "Transport", "move", "Glyceryl"], 2: [], 3: ["transport"]}
    assert maps.select(retrieval.valid_map(F.col("query_expansion"))).first()[0]
    for bad in ("map('A', array('x'))", "map('a', array())", "map('a', array(' '))"):
        assert not spark.sql(f"select cast({bad} as map<string,array<string>>) m").select(retrieval.valid_map(F.col("m"))).first()[0]


def test_phrases_are_found_by_a_piece(spark):
    """The same rows as matching every phrase with every question, signs and repeated words included; empty phrases and nulls stand nowhere."""
    said = ["the pump.net failed", "c++ and the c+ are not c", "a valve, of the pump", "", None, "the the the", "d\u00e9bit no. 5 (of 7)", "x" * 5000 + " of the pump"]
    known = ["pump", ".net", "c++", "of the", "the", "the the", "d\u00e9bit", "no. 5", "(", "5 (of", "pum", "valve,", "of the pump", " ", "", None]
    q = spark.createDataFrame([*enumerate(said)], "question_id int, question string")
    p = spark.createDataFrame([(i, t, [f"t{i}"]) for i, t in enumerate(known)], "ord int, phrase string, terms array<string>")
    edge = lambda t: re.compile(rf"(?<!\w){re.escape(t)}(?!\w)")
    want = {(i, j) for i, s in enumerate(said) if s for j, t in enumerate(known) if t and edge(t).search(s)}
    got = [(r.question_id, r.ord) for r in retrieval.hits(q, p.unionByName(p)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 12
    assert retrieval.hits(q.limit(0), p).count() == 0 and retrieval.hits(q, p.limit(0)).count() == 0


def test_many_phrases(spark):
    """A vocabulary of 100,000 phrases that all share a word: no nested loop, and each question meets its own."""
    p = spark.range(100_000).select(F.col("id").cast("int").alias("ord"), F.concat(F.lit("the part "), F.col("id")).alias("phrase"), F.array(F.lit("t")).alias("terms"))
    q = spark.range(200).select(F.col("id").alias("question_id"), F.concat(F.lit("Where is the part "), F.col("id") * 499, F.lit("?")).alias("question"))
    found = retrieval.hits(q, p)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {(r.question_id, r.ord) for r in found.collect()} == {(i, i * 499) for i in range(200)}


def test_smoke(spark, tmp_path):
    (tmp_path / "cases.jsonl").write_text('# remark\n{"id": "a", "question": "q", "expect": {"answered": true, "contains": ["16|sixteen"], "not_contains": ["no idea"]}, "tags": ["t"]}\n\n')
    case = files.smoke_cases(spark, str(tmp_path / "cases.jsonl"))
    rows = case.select("id", "expect.contains", "expect.not_contains").crossJoin(spark.createDataFrame([("SIXTEEN of them",), ("16, no IDEA why",), ("none",)], "answer string"))
    assert {r.answer: r.passed for r in retrieval.smoke(rows).collect()} == {"SIXTEEN of them": True, "16, no IDEA why": False, "none": False}


def test_check_plan(spark):
    specs = spark.createDataFrame([("osha", ["cfr-29", "osha-directives"]), ("epa", None), ("odd", None)], "pack_id string, members array<string>")
    asked = spark.createDataFrame([("cfr-29",), ("epa-lead",), ("odd",), ("osha",), ("nothing",)], "pack_id string")
    got = {r.pack_id: (r.owner, r.method, r.detail) for r in freshness.plan(asked, specs).collect()}
    assert got == {"cfr-29": ("osha", "api_date", ""), "epa-lead": (None, "harvest", ""), "odd": ("odd", None, "no checker for this pack"), "osha": ("osha", None, "no checker for this pack"), "nothing": (None, None, "unknown pack")}
    r = freshness.report("epa", "harvest", freshness.harvest(None, spark.createDataFrame([], "key string"))).first()
    assert r.pack == "epa" and r.method == "harvest" and r.stale is None and len(r.checked_at) >= 20


def test_facts_of_files_read_in_blocks(spark, dist, tmp_path, monkeypatch):
    folder, written, _ = dist
    (folder / "none.tar.zst").write_bytes(b"no archive at all")
    found = {r.artifact: r for r in streams.facts(files.artifacts(spark, str(folder))).collect()}
    for w in written.values():
        assert (found[w.artifact].found_sha256, found[w.artifact].found_bytes) == (w.sha256, w.bytes)
    assert json.loads(found["content-2026.01.02.tar.zst"].manifest)["doc_count"] == 2 and found["none.tar.zst"].manifest is None
    gone = spark.createDataFrame([("x.tar.zst", f"{folder}/x.tar.zst")], "artifact string, place string")
    assert streams.facts(gone).collect() == []
    assert streams.facts(files.artifacts(spark, f"{folder}/nowhere")).collect() == []


def test_a_file_larger_than_a_row_is_verified(spark, tmp_path):
    """More than 2 GB, which no row can hold; its blocks are zeros that take no disk."""
    import hashlib

    size, zeros, digest = (1 << 31) + 4097, bytes(1 << 20), hashlib.sha256()
    with open(tmp_path / "large.tar.zst", "wb") as f:
        f.truncate(size)
    for at in range(0, size, len(zeros)):
        digest.update(zeros[: min(len(zeros), size - at)])
    wanted = spark.createDataFrame([("large.tar.zst", digest.hexdigest()), ("absent.tar.zst", "")], "artifact string, artifact_sha256 string")
    assert sorted(map(tuple, packs.verified(wanted, files.artifacts(spark, str(tmp_path))).collect())) == [("absent.tar.zst", "absent"), ("large.tar.zst", "verified")]


_VALUES = st.recursive(st.one_of(st.none(), st.integers(), st.text(alphabet='ab"\\[]{},:é files', max_size=8)), lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.sampled_from(["files", "a", 'q"', "b\\"]), x, max_size=3)), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.sampled_from(["files", "file", "x", 'fi"les', "files\\", "filesfiles"]), _VALUES, max_size=5), st.integers(1, 9), st.booleans(), st.sampled_from([None, 1]))
def test_the_list_of_a_manifest_is_passed_over(value, step, plain, indent):
    text = json.dumps(value, ensure_ascii=plain, indent=indent).encode()
    parts = (text[i : i + step] for i in range(0, len(text), step))
    assert json.loads(streams.without(parts, "files")) == {k: [] if k == "files" and isinstance(v, list) else v for k, v in value.items()}


def test_a_manifest_is_bounded_beside_its_list(monkeypatch):
    monkeypatch.setattr(streams, "LIMIT", 1000)
    entries = (b'{"path":"a","chars":1},' for _ in range(10_000))
    parts = itertools.chain([b'{"pack_id":"p","files":['], entries, [b'{}],"rest":1}'])
    assert json.loads(streams.without(parts, "files")) == {"pack_id": "p", "files": [], "rest": 1}
    with pytest.raises(ValueError, match="1000 bytes"):
        streams.without(iter([b'{"note":"', b"x" * 2000, b'"}']), "files")
