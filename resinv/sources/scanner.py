"""Page scans, liveness checks and archive look-ups over injectable fetchers, one row per distinct URL.

Fetchers run in the tasks.  All URLs of a host are in one task, in which hosts are served by a pool of threads and
the requests of one host follow each other with a wait; a URL that fails or takes too long becomes a row with its
error, never a lost URL.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, TimeoutError
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resinv.functions import urls as ux

#: Fixed value: how many meta refreshes a scan follows.
HOPS = 3
Fetch = Callable[[str], tuple[int, str, str]]
"""From a URL its status code, the URL it ended at and the page."""


def refresh_target(base: str, page: str) -> str:
    """The absolute target of a page's meta refresh, '' if it has none."""
    m = re.search(ux.REFRESH, page or "")
    return urljoin(base, m.group(1).strip()) if m and m.group(1).strip() else ""


def fetch_page(url: str, fetch: Fetch, hops: int = HOPS) -> tuple[int, str, str, int]:
    """Status code, last URL, page and number of refreshes followed; a refresh to a URL seen before ends the walk."""
    seen = {url}
    code, final, page = fetch(url)
    taken = 0
    while taken < hops and (target := refresh_target(final, page)) and target not in seen:
        seen.add(target)
        code, final, page = fetch(target)
        taken += 1
    return code, final, page, taken


def _by_host(urls: DataFrame, url: str, each: Callable[[str], tuple], names: list[str], schema: str, wait: float, threads: int, seconds: float) -> DataFrame:
    distinct = urls.select(F.trim(F.col(url)).alias("url")).filter("url is not null and url <> ''").distinct().withColumn("host", ux.authority("url"))
    tasks = max(1, int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        last: dict[str, float] = {}

        def one(u: str) -> tuple:
            try:
                return (*each(u), None)
            except Exception as e:  # noqa: BLE001  (an error is a result here)
                return (*[None] * (len(names) - 2), f"{type(e).__name__}: {e}"[:500])

        def serve(host: str, listed: list[str]) -> list[tuple]:
            rows = []
            for u in listed:
                pause = last.get(host, 0.0) + wait - time.monotonic()
                if wait and pause > 0:
                    time.sleep(pause)
                single = ThreadPoolExecutor(1)
                try:
                    got = single.submit(one, u).result(timeout=seconds)
                except TimeoutError:
                    got = (*[None] * (len(names) - 2), f"timeout after {seconds} s")
                single.shutdown(wait=False)  # a request that hangs is left behind
                last[host] = time.monotonic()
                rows.append((u, *got))
            return rows

        for pdf in batches:
            hosts = {h: list(g) for h, g in pdf.groupby("host")["url"]}
            with ThreadPoolExecutor(threads) as pool:
                rows = [r for part in pool.map(lambda x: serve(*x), hosts.items()) for r in part]
            yield pd.DataFrame(rows, columns=names).astype({n: "Int64" for n in ("status_code", "hops") if n in names})

    return distinct.repartition(tasks, "host").mapInPandas(run, schema)


def scan_urls(urls: DataFrame, url: str, fetch: Fetch, archive: DataFrame | None = None, wait: float = 0.0, threads: int = 10, seconds: float = 120.0) -> DataFrame:
    """One row per distinct non-blank URL: what was fetched, its title, indicator scores and likelihood.

    Up to HOPS meta refreshes are followed, their targets resolved against the page.  A URL that cannot be fetched
    has ``status`` error and takes the latest copy of ``archive`` (url, stamp, archive_url), where it has one.
    """
    names = ["url", "status_code", "final_url", "html", "hops", "error_message"]
    got = _by_host(urls, url, lambda u: fetch_page(u, fetch), names, "url string, status_code long, final_url string, html string, hops long, error_message string", wait, threads, seconds)
    page = got.withColumn("title", ux.page_title("html"))
    scored = page.select("url", "status_code", "final_url", "hops", "error_message", "title", F.length("html").alias("content_length"), *[v.alias(k) for k, v in ux.page_scores("html", "title").items()])
    status = F.when(F.col("error_message").isNotNull(), "error").when(F.col("status_code") < 400, "ok").otherwise("dead")
    out = scored.withColumn("status", status).withColumn("likelihood", F.when(F.col("status") == "ok", ux.likelihood(F.col("total_score"))).otherwise("VERY LOW"))
    if archive is None:
        return out.withColumns({"wayback_url": F.lit(""), "wayback_date": F.lit("")})
    return latest_snapshot(out, "url", archive, F.col("status") != "ok")


def latest_snapshot(df: DataFrame, url: str, snapshots: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Archived copies joined to URLs: the latest snapshot with its date, '' where there is none; of equal stamps the
    larger address.  ``wanted`` is a condition on the rows that look for one."""
    best = snapshots.filter("url is not null and stamp is not null").groupBy(F.col("url").alias("_u")).agg(F.max(F.struct("stamp", "archive_url")).alias("_best"))
    on = F.col(url) == F.col("_u")
    joined = df.join(best, on if wanted is None else on & wanted, "left")
    return joined.withColumn("wayback_date", F.coalesce(ux.snapshot_date("_best.stamp"), F.lit(""))).withColumn("wayback_url", F.coalesce("_best.archive_url", F.lit(""))).drop("_u", "_best")


def check_urls(urls: DataFrame, url: str, head: Callable[[str], tuple[int, str]], places: DataFrame, wait: float = 0.0, threads: int = 10, seconds: float = 30.0) -> DataFrame:
    """``(url, status_code, address, live, country, coordinates, error_message)`` of each distinct non-blank URL.

    ``head`` gives the status code and network address; ``places`` (address, country, coordinates) says where an
    address is, the smallest row of an address deciding.  An address that is not known has blank places.
    """
    names = ["url", "status_code", "address", "error_message"]
    got = _by_host(urls, url, head, names, "url string, status_code long, address string, error_message string", wait, threads, seconds)
    one = places.groupBy(F.col("address").alias("_a")).agg(F.min(F.struct("country", "coordinates")).alias("_p"))
    joined = got.join(one, got["address"] == F.col("_a"), "left")
    live = F.coalesce(F.col("status_code").isin(200, 301, 302), F.lit(False))
    return joined.select("url", "status_code", "address", live.alias("live"), F.coalesce("_p.country", F.lit("")).alias("country"), F.coalesce("_p.coordinates", F.lit("")).alias("coordinates"), "error_message")
