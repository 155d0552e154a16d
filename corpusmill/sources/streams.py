"""Files of any size, read on the executors a block at a time; no row ever holds one.

Spark's own reader of whole files makes each a row, of 2 GB at most.  Here a row is a file's place: a task opens it by
its scheme, reads it once from its beginning, and gives what was asked of it.  Every file is a task's own work, so a
lost executor costs the files it had open.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of a block, and the most bytes of a manifest beside its list of files
BLOCK, LIMIT = 1 << 20, 64 << 20
MANIFEST = "manifest.json"


def opened(place: str) -> io.BufferedIOBase:
    """The file at an address or path, to be read from its beginning. Schemes are those of Arrow's file systems: file, hdfs, s3, gs and others."""
    at = re.sub(r"\Afile:/+", "/", place)
    if at.startswith("/"):
        return open(at, "rb", buffering=BLOCK)  # noqa: SIM115
    system, path = fs.FileSystem.from_uri(place)
    return system.open_input_stream(path, buffer_size=BLOCK)


class Hashed(io.RawIOBase):
    """A file that is read once, with the digest and the number of the bytes read so far."""

    def __init__(self, inner):
        self.inner, self.digest, self.n = inner, hashlib.sha256(), 0

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        got = self.inner.read(len(into))
        into[: len(got)] = got
        self.digest.update(got)
        self.n += len(got)
        return len(got)

    def rest(self) -> None:
        """Read to the end."""
        while self.read(BLOCK):
            pass


_PIECE = re.compile(rb'[\\"{}\[\],]|[^\\"{}\[\],]+')


def without(parts: Iterator[bytes], name: str) -> bytes:
    """A JSON object's text, from its parts, with the list that one of its own fields holds left empty; the list is passed over as it comes."""
    out, word = bytearray(), bytearray()
    wanted, last, depth = json.dumps(name).encode(), b"", 0
    quoted = escaped = passing = False
    for part in parts:
        for piece in _PIECE.findall(part):
            before = passing
            if escaped:
                escaped = False
            elif quoted:
                quoted, escaped = piece != b'"', piece == b"\\"
            elif piece == b'"':
                quoted, word = True, bytearray()
            elif piece in b"{[":
                passing = passing or (piece == b"[" and depth == 1 and last == wanted)
                depth += 1
            elif piece in b"}]":
                depth -= 1
                passing = passing and depth > 1
            elif piece == b",":
                last = b"" if depth == 1 else last
            if not passing and depth == 1 and len(word) <= len(wanted):
                word += piece
                last = bytes(word) if piece == b'"' and not quoted and not escaped else last
            if not (passing and before):
                out += piece
                if len(out) > LIMIT:
                    raise ValueError(f"a manifest has more than {LIMIT} bytes beside its list")
    return bytes(out)


def manifest(packed: io.RawIOBase) -> str | None:
    """The manifest of a packed archive, its list of files left empty; None for what is none. The archive is read as far as its manifest."""
    try:
        with zstandard.ZstdDecompressor().stream_reader(packed, closefd=False) as z, tarfile.open(fileobj=z, mode="r|", bufsize=BLOCK) as tar:
            for entry in tar:
                if entry.name == MANIFEST:
                    held = tar.extractfile(entry)
                    return without(iter(lambda: held.read(BLOCK), b""), "files").decode()
    except (tarfile.TarError, zstandard.ZstdError, UnicodeDecodeError):
        pass
    return None


FACTS = "artifact string, found_bytes long, found_sha256 string, manifest string"


def facts(artifacts: DataFrame, manifests: bool = True) -> DataFrame:
    """(artifact, found_bytes, found_sha256, manifest) of artifacts (artifact, place), each read once, BLOCK bytes at a time.

    Places are spread over as many tasks as there are files, up to the session's partitions.  A file that is gone by then gives no
    row; one that is no packed archive has no manifest.
    """

    def read(batches):
        for batch in batches:
            for name, place in zip(*(batch.column(c).to_pylist() for c in ("artifact", "place")), strict=True):
                try:
                    inner = opened(place)
                except FileNotFoundError:
                    continue
                with inner:
                    held = Hashed(inner)
                    text = manifest(held) if manifests else None
                    held.rest()
                row = {"artifact": name, "found_bytes": held.n, "found_sha256": held.digest.hexdigest(), "manifest": text}
                yield pa.RecordBatch.from_pylist([row], pa.schema([("artifact", pa.string()), ("found_bytes", pa.int64()), ("found_sha256", pa.string()), ("manifest", pa.string())]))

    spread = artifacts.select("artifact", "place").repartition(int(artifacts.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("place"))
    return spread.mapInArrow(read, FACTS)
