"""From a tree of files to a signed, verified folder of packs, stage by stage."""

import io
import json
import tarfile

import pytest
import zstandard
from pyspark.sql import functions as F

from corpusmill import cli, schemas
from corpusmill.operators import build, freshness, retrieval
from corpusmill.sources import state

LETTER = "This part tells what is asked of everyone who does the work that it names, and when. "
EXPANSION = {"lockout": ["energy control", "hazardous energy"], "fall": ["fall protection"]}
SPECS = {
    "osha": {"pack_id": "osha", "kind": "meta", "title": "Labor bundle", "publisher": "P", "rights_tier": "public-domain", "members": ["cfr-29", "osha-publications"], "required_members": ["cfr-29"], "description": "All", "query_expansion": EXPANSION, "refresh": {"method": "api_date", "cadence_days": 7}},
    "epa": {"pack_id": "epa", "kind": "meta", "title": "Environment", "short_title": "ENV", "publisher": "P", "rights_tier": "public-domain", "members_from": {"corpus": "EPA", "split_by": "section", "member_id": "epa-{section}", "exclude_sections": ["mold"]}, "query_expansion": {"paint": ["lead"]}},
    "other": {"pack_id": "other", "kind": "content", "title": "Other", "corpus": "NFPA-Public", "publisher": "P", "rights_tier": "free", "rights_note": "Ask \"first\""},
}


@pytest.fixture
def root(tmp_path):
    for corpus, names in {"CFR-29": ["Sections/1910.1.txt", "Sections/1910.2.txt"], "EPA": ["lead/a.txt", "lead/é.txt", "mold/m.txt", "greenchemistry/g.txt"]}.items():
        for i, name in enumerate(names):
            place = tmp_path / "docs" / corpus / name
            place.parent.mkdir(parents=True, exist_ok=True)
            place.write_text(f"{LETTER}{corpus} {name} " * (i + 2), encoding="utf-8")
    (tmp_path / "docs/CFR-29/manifest.csv").write_text('relative_path,citation,section,subject,part,part_name,issue_date,source_url,publisher,bytes,sha256\nSections/1910.1.txt,29 CFR 1910.1,1910.1,"Scope, ""all""",1910,General,2026-01-01,https://x.org/1910.1,P,10,' + "a" * 64 + "\n", encoding="utf-8")
    (tmp_path / "specs").mkdir()
    for name, spec in SPECS.items():
        (tmp_path / "specs" / f"{name}.json").write_text(json.dumps(spec), encoding="utf-8")
    return tmp_path


def run(capsys, root, stage, *more):
    code = cli.main(["--root", str(root / "docs"), stage, "--dist", str(root / "dist"), "--specs", str(root / "specs"), *more])
    return code, json.loads(capsys.readouterr().out)


def manifest(path):
    with zstandard.ZstdDecompressor().stream_reader(path.read_bytes()) as z, tarfile.open(fileobj=io.BytesIO(z.read())) as tar:
        names = tar.getnames()
        return json.loads(tar.extractfile("manifest.json").read()), {n: tar.extractfile(n).read().decode() for n in names[1:]}, names


def test_tree_to_verified_folder(spark, capsys, root):
    state.record_capture(spark, f"{root}/docs/_state", "CFR-29", "2026-02-03")
    state.record_capture(spark, f"{root}/docs/_state", "EPA", "2026-03-04")
    assert run(capsys, root, "extract") == (0, {"ok": 6})
    audit = (root / "docs/_EXTRACTION_AUDIT.csv").read_text().splitlines()
    assert audit[0].startswith("corpus,relative_path,status") and [x.split(",")[0] for x in audit[1:]] == ["CFR-29"] * 2 + ["EPA"] * 4
    _, found = run(capsys, root, "index")
    assert found["index"]["embed"] == 6 and found["master"]["by_corpus"] == {"CFR-29": 1}
    listed = (root / "docs/_TEXT_DEDUPE.csv").read_text().splitlines()
    assert listed[1:] == sorted(listed[1:]) and len(listed) == 7
    _, made = run(capsys, root, "build")
    packs = {p["pack_id"]: p for p in made["packs"]}
    assert set(packs) == {"osha", "epa", "cfr-29", "osha-publications", "epa-lead", "epa-greenchemistry", "other"}
    assert packs["other"]["skipped"] == packs["osha-publications"]["skipped"] == "no embed=yes text" and packs["osha"]["members"] == ["cfr-29", "osha-publications"]
    assert packs["epa"]["members"] == ["epa-greenchemistry", "epa-lead"] and packs["cfr-29"]["artifact"] == "cfr-29-2026.02.03.tar.zst" and packs["epa"]["artifact"] == "epa-2026.03.04.tar.zst"
    assert json.loads((root / "dist/build-results.json").read_text()) == made["packs"]

    one, texts, names = manifest(root / "dist" / packs["cfr-29"]["artifact"])
    assert names == ["manifest.json", "text/Sections/1910.1.txt", "text/Sections/1910.2.txt"]
    assert one["query_expansion"] == EXPANSION and one["refresh"] == {"method": "api_date", "cadence_days": 7} and one["section"] is None
    assert one["title"] == "29 CFR - Occupational Safety and Health Standards" and one["doc_count"] == len(one["files"]) == 2 and one["text_bytes"] == sum(f["chars"] for f in one["files"])
    first = one["files"][0]
    assert (first["path"], first["source_url"], first["title"], first["identifier"]) == ("text/Sections/1910.1.txt", "https://x.org/1910.1", 'Scope, "all"', "29 CFR 1910.1") and one["files"][1]["source_url"] == ""
    assert texts["text/Sections/1910.2.txt"].startswith(LETTER)
    lead, texts, _ = manifest(root / "dist" / packs["epa-lead"]["artifact"])
    assert (lead["title"], lead["section"], lead["query_expansion"]) == ("ENV - Lead", "lead", {"paint": ["lead"]}) and sorted(texts) == ["text/lead/a.txt", "text/lead/é.txt"]
    bundle, texts, _ = manifest(root / "dist" / packs["osha"]["artifact"])
    assert bundle["kind"] == "meta" and bundle["required_members"] == ["cfr-29"] and not texts and "files" not in bundle

    assert run(capsys, root, "catalog")[1] == {"packs": 5, "content": 3, "meta": 2}
    key = str(root / "key")
    public = run(capsys, root, "keygen", "--key", key)[1]["public_key"]
    run(capsys, root, "sign", "--key", key)
    code, verified = run(capsys, root, "verify", "--public-key", public)
    assert code == 0 and not verified["mismatched"] and len(verified["verified"]) == 5


def test_only_one_and_status(spark, capsys, root):
    run(capsys, root, "extract")
    run(capsys, root, "index")
    _, made = run(capsys, root, "build", "--only", "epa", "--version", "1.0", "--captured", "2020-01-01")
    assert {p["pack_id"] for p in made["packs"]} == {"epa", "epa-lead", "epa-greenchemistry"} and all(p["artifact"].endswith("-1.0.tar.zst") for p in made["packs"])
    _, found = run(capsys, root, "status")
    assert found["corpora"] == {"CFR-29": {"files": 2, "manifest": True}, "EPA": {"files": 4, "manifest": False}} and found["MASTER-INDEX.csv"] is True
    assert found["freshness_due"] == ["cfr-29", "osha-publications"]


def test_checks_are_dispatched_and_recorded(spark, capsys, root):
    state.record_capture(spark, f"{root}/docs/_state", "CFR-29", "2026-02-03")
    _, found = run(capsys, root, "check", "--pack", "cfr-29", "--date", "2026-05-01")
    assert [(c["pack"], c["method"], c["stale"]) for c in found["checks"]] == [("cfr-29", "api_date", True)]
    (root / "list.txt").write_text("https://x.org/a?x=1\nhttps://x.org/b\n")
    _, found = run(capsys, root, "check", "--due", "--listing", str(root / "list.txt"))
    assert [(c["pack"], c["method"], c["stale"], c["added"]) for c in found["checks"]] == [("osha-publications", "manifest_hash", True, 2)]
    assert run(capsys, root, "check", "--due")[1] == {"due": []}
    _, found = run(capsys, root, "check", "--pack", "osha-interpretations")
    assert found["checks"][0]["stale"] is None
    _, found = run(capsys, root, "check", "--pack", "none-such")
    assert found["checks"][0]["detail"] == "unknown pack" and found["checks"][0]["method"] is None


def test_identifiers_without_regard_to_case(spark):
    current, known = (spark.createDataFrame([(x,) for x in v], "key string") for v in (["CPL-1", "cpl-2", "new-3"], ["cpl-1", "CPL-2", "old-9"]))
    r = freshness.new_identifiers(current, known).first()
    assert (r.stale, r.added, r.removed, r.added_sample) == (True, 1, 1, ["new-3"])


def test_smoke_flags(spark):
    cases = spark.createDataFrame([("a", "x", (True, None, True, ["ten"], None)), ("b", "x", (None, True, None, None, ["no"])), ("c", "x", (True, None, True, None, None)), ("d", "x", (True, None, None, None, None))], "id string, category string, expect struct<answered: boolean, gated: boolean, no_blanket_absence: boolean, contains: array<string>, not_contains: array<string>>")
    answers = spark.createDataFrame([("a", "Within Ten days", True, False), ("b", "yes", True, True), ("c", "I do not know; no information available", True, False)], "id string, answer string, answered boolean, gated boolean")
    assert {r.id: r.passed for r in retrieval.evaluated(cases, answers).collect()} == {"a": True, "b": True, "c": False, "d": False}


def test_empty_specs(spark, tmp_path):
    specs = spark.createDataFrame([], schemas.PACK_SPEC)
    files = spark.createDataFrame([], f"corpus string, {schemas.PACK_FILE}, text_path string")
    none = spark.createDataFrame([], "corpus string, captured_at string")
    assert build.build(specs, files, files.select("text_path", F.lit("").alias("text")), none, str(tmp_path)).count() == 0
