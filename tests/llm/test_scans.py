"""Scans stay linear in the text; bare "at" needs a sign; the as-of join against brute force."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from triage.llm import pii, secret_scan, url_filter


@pytest.mark.parametrize("text", ["look at google.com", "met at example.org", "starts at bbc.co.uk", "3.2 at node.js",
                                  "contact us at example.com", "write to me at example.com", "the mail came. Look at example.com"])
def test_prose_is_no_address(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize(("text", "hit"), [
    ("write to jo at example.com", "jo at example.com"), ("Contact: jo.smith at example.co.uk", "jo.smith at example.co.uk"),
    ("jo at example dot com", "jo at example dot com"), ("jo (at) example.com", "jo (at) example.com")])
def test_introduced_names_are_addresses(text, hit):
    at = text.index(hit)
    assert ("email", at, at + len(hit)) in pii.find(text)[1]


def test_base_and_added_spans_merge_as_pairwise():
    rng = random.Random(5)
    for _ in range(400):
        spans = sorted((a, 0, a + rng.randint(1, 6)) for a in (rng.randint(0, 30) for _ in range(rng.randint(0, 5))))
        covered = secret_scan.Covered(spans)
        a = rng.randint(0, 30)
        b = a + rng.randint(1, 12)
        assert covered.meets(a, b) == any(x < b and a < y for x, _, y in spans)
        assert covered.within(a, b) == all(b <= x or y <= a or (a <= x and y <= b) for x, _, y in spans)


@pytest.mark.parametrize(("find", "unit"), [
    (pii.find, "mail a.b@c.de, call +1 six three two 555 4827, jo at ex dot com \n"),
    (secret_scan.find, "password=abcdefghijkl123 k A9fK2mQ8zL1vX7cB4nR6tY3wPq x deadbeefdeadbeef00 \n"),
])
def test_long_texts_in_linear_time(find, unit):
    start = time.process_time()
    one = len(find(unit * 10)[1])
    assert len(find(unit * 20_000)[1]) == 2_000 * one
    assert time.process_time() - start < 30


@pytest.mark.parametrize("text", [" " * 200_000 + "x (at) y", "x" + " " * 200_000 + "dot 1", "a." * 100_000, "x at " * 40_000, "1 dot " * 40_000])
def test_runs_in_linear_time(text):
    start = time.process_time()
    pii.find(text)
    assert time.process_time() - start < 10


def _judged(at, host, path, log):
    """Verdict and key of a capture by looking at every entry."""
    state = {}
    for key, since, action in sorted(log):
        if since <= at and (key not in state or state[key][0] < since):
            state[key] = (since, action)
    found = []
    for key, (_, action) in state.items():
        if action == "remove":
            continue
        h, slash, _ = key.partition("/")
        if slash and (host + path).startswith(key):
            found.append((1, len(key), key, action))
        elif not slash and (host == h or host.endswith("." + h)):
            found.append((0, len(key), key, action))
    return (max(found)[3], max(found)[2]) if found else ("none", None)


def test_as_of_with_stray_dates(spark):
    rng = random.Random(11)
    zero = datetime(2024, 1, 1, tzinfo=timezone.utc)
    days = [0, 1, 29, 30, 31, 60, 400, -20_000, 2_900_000]
    hosts, paths = ["a.x.org", "x.org", "b.net", "c.b.net"], ["/", "/p/", "/p/q/r", "/P/q"]
    when = lambda: zero + timedelta(days=rng.choice(days), seconds=rng.choice([0, 86399, rng.randint(0, 86400)]))
    log = sorted({(k, t): (k, t, rng.choice(["allow", "block", "remove"])) for k, t in
                  ((rng.choice(["x.org", "org", "b.net", "b.net/p/", "a.x.org/p/q/", "c.b.net"]), when()) for _ in range(60))}.values())
    caps = [(i, rng.choice(hosts), rng.choice(paths), when()) for i in range(300)]
    ent = spark.createDataFrame([(k, a, int(t.timestamp())) for k, t, a in log], "key string, action string, s long").select(
        "key", "action", F.timestamp_seconds("s").alias("since"))
    cap = spark.createDataFrame([(i, f"http://{h}{p}", int(t.timestamp())) for i, h, p, t in caps], "page_id long, url string, s long").select(
        "page_id", "url", F.timestamp_seconds("s").alias("fetched"))
    got = {r.page_id: (r.verdict, r.key) for r in url_filter.judge(cap, ent).select("page_id", "verdict", "key").collect()}
    assert got == {i: _judged(t, h, p, log) for i, h, p, t in caps}
    assert url_filter.judge(cap, ent.withColumn("action", F.lit(None).cast("string"))).filter("verdict <> 'none'").isEmpty()
