"""Fetching pages politely: one task a host, so a host's clock and its blocks are local to a task.

Live fetching sits behind `client`, a function (url, headers) -> (status, bytes); the engine's own tests
and queries never use the network.
"""

from __future__ import annotations

import os
import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import cache_key
from corpusmill.operators.collect import FORBIDDEN_HOSTS, policy_of

ATTEMPTS = 5
#: statuses that stop a host, and those that mean a page is gone
BLOCKED, GONE = (403, 429, 503), (404, 410)


def urllib_client(url: str, headers: dict[str, str]) -> tuple[int, bytes]:
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers=headers), timeout=60) as r:  # noqa: S310
            return r.status, r.read()
    except HTTPError as e:
        return e.code, b""


def fetch_one(url: str, delay: float, backoff: float, client: Callable, sleep: Callable = time.sleep) -> tuple[str, bytes | None]:
    """(outcome, content) of one address: ok, gone, failed. A block stops this host for longer each time."""
    errors = 0
    for attempt in range(ATTEMPTS):
        try:
            status, content = client(url, {"Accept-Encoding": "identity"})
        except Exception:  # noqa: BLE001  a network error is retried once
            errors += 1
            if errors == 2:
                return "failed", None
            sleep(2 * (attempt + 1))
            continue
        if status == 200:
            sleep(delay)
            return "ok", content
        if status in GONE:
            return "gone", None
        sleep(backoff * (attempt + 1) + random.uniform(0, 10) if status in BLOCKED else 2 * (attempt + 1))
    return "failed", None


def by_host(asked: list[tuple], ask: Callable) -> list:
    """ask(host, ...) of rows (host, workers, ...), in order; a host is asked by as many threads at once as it allows, hosts one after the other."""
    out: list = [None] * len(asked)
    for host in dict.fromkeys(r[0] for r in asked):
        at = [i for i, r in enumerate(asked) if r[0] == host]
        with ThreadPoolExecutor(max_workers=max(1, asked[at[0]][1])) as pool:
            for i, found in zip(at, pool.map(lambda i: ask(asked[i][0], *asked[i][2:]), at), strict=True):
                out[i] = found
    return out


def fetch(urls: DataFrame, client: Callable = urllib_client, sleep: Callable = time.sleep) -> DataFrame:
    """(url, outcome, body) of urls (url), each host in one task; forbidden hosts are not asked."""
    rows = policy_of(urls.select("url").distinct()).repartition("host")

    def run(batches):
        for batch in batches:
            asked = list(zip(*(batch.column(c).to_pylist() for c in ("host", "workers", "url", "delay", "block_backoff")), strict=True))
            got = by_host(asked, lambda h, u, d, b: ("forbidden", None) if h in FORBIDDEN_HOSTS else fetch_one(u, d, b, client, sleep))
            yield pa.RecordBatch.from_arrays([batch.column("url"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1].decode(errors="replace") if g[1] is not None else None for g in got], pa.string())], ["url", "outcome", "body"])

    return rows.mapInArrow(run, "url string, outcome string, body string")


def download(plan: DataFrame, folder: str, client: Callable = urllib_client, sleep: Callable = time.sleep) -> DataFrame:
    """(url, path, outcome) of a plan (url, path): each file written beside its place and renamed, so it is whole or absent.

    Files that are there already are kept. Content that is not what the extension says is wrong_type and
    not written. folder must be one that all executors share.
    """
    from corpusmill.operators.extract import MAGIC

    rows = policy_of(plan.select("url", "path")).repartition("host")

    def one(url: str, path: str, host: str, delay: float, backoff: float) -> str:
        place = os.path.join(folder, path)
        if os.path.exists(place) and os.path.getsize(place):
            return "already"
        if host in FORBIDDEN_HOSTS:
            return "forbidden"
        outcome, content = fetch_one(url, delay, backoff, client, sleep)
        mark = MAGIC.get(os.path.splitext(path)[1].lower(), b"")
        if content is None or not content.startswith(mark):
            return outcome if content is None else "wrong_type"
        os.makedirs(os.path.dirname(place), exist_ok=True)
        with open(place + ".part", "wb") as f:
            f.write(content)
        os.replace(place + ".part", place)
        return outcome

    def run(batches):
        for batch in batches:
            asked = list(zip(*(batch.column(c).to_pylist() for c in ("host", "workers", "url", "path", "delay", "block_backoff")), strict=True))
            done = by_host(asked, lambda h, u, p, d, b: one(u, p, h, d, b))
            yield pa.RecordBatch.from_arrays([batch.column("url"), batch.column("path"), pa.array(done, pa.string())], ["url", "path", "outcome"])

    return rows.mapInArrow(run, "url string, path string, outcome string")


def cached(urls: DataFrame, cache: DataFrame, fetcher: Callable = fetch, least: int = 3000, refresh: bool = False) -> DataFrame:
    """(url, body): cached pages of at least `least` bytes, and the others fetched; all fetched with refresh. cache has (url, body)."""
    hits = cache.filter(F.octet_length("body") >= least).select("url", "body")
    hits = hits.filter(F.lit(not refresh))
    misses = urls.join(hits, "url", "left_anti")
    return urls.join(hits, "url").select("url", "body").unionByName(fetcher(misses).filter("outcome = 'ok'").select("url", "body"))


def counters(fetched: DataFrame) -> DataFrame:
    return fetched.groupBy("outcome").agg(F.count("*").alias("requests"))


def named(urls: DataFrame) -> DataFrame:
    return urls.withColumn("name", cache_key(F.col("url")))
