"""Cases that a part of the job would miss."""

import pytest
from pyspark.sql import functions as F

from triage.llm import pieces, pii, secret_scan, url_filter


def test_dropout_varies_by_document_and_occurrence():
    pytest.importorskip("sentencepiece")
    voc = pieces.load()
    text = " ".join(["international"] * 400)
    per_doc = [pieces.encode(text, voc, 0.1, 1, d).tolist() for d in range(6)]
    assert len({tuple(x) for x in per_doc}) == 6 and per_doc[2] == pieces.encode(text, voc, 0.1, 1, 2).tolist()
    assert all(pieces.decode(x, voc) == text for x in per_doc)
    words, word = set(), []
    for i in per_doc[0]:  # a word's first piece opens with the space
        if voc.out[i].startswith(b" ") and word:
            words.add(tuple(word))
            word = []
        word.append(i)
    assert len(words) > 5
    many = pieces.encode_many([text, "a b", text], voc, 0.1, 1, [0, 9, 5])
    assert many[0].tolist() == per_doc[0] and many[2].tolist() == per_doc[5]  # other texts of the batch don't matter


def test_urls_of_any_depth_and_path_case(spark):
    folders = "/".join("abcdefghij")
    urls = ["http://a.b.c.d.e.f.example.org/", f"http://h.net/{folders}/x", "http://only.ru/", "http://c.com/EN/x", "http://c.com/en/x", f"http://{'s.' * 120}deep.io/"]
    keys = [("example.org", "block"), (f"h.net/{folders}/", "block"), ("h.net/a/", "allow"), ("ru", "block"), ("C.com/EN/", "block"), ("deep.io", "block"), ("io", "allow")]
    cap = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("fetched", F.timestamp_seconds(F.lit(10)))
    ent = spark.createDataFrame(keys, "key string, action string").withColumn("since", F.timestamp_seconds(F.lit(1)))
    got = {r.page_id: (r.verdict, r.key) for r in url_filter.judge(cap, ent).collect()}
    assert got == {0: ("block", "example.org"), 1: ("block", f"h.net/{folders}/"), 2: ("block", "ru"), 3: ("block", "c.com/EN/"),
                   4: ("none", None), 5: ("block", "deep.io")}


@pytest.mark.parametrize("text", ["URL=https://api.x.io/v1\nKEY={}", "https://api.x.io/v1\t{}", '{{"u":"https://a.io","k":"{}"}}', "a https://a.io/x,{} b", "(https://a.io){}"])
def test_secrets_after_a_url(text):
    key = "A9fK2mQ8zL1vX7cB4nR6tY3wPq"
    full = text.format(key)
    assert any(a <= full.index(key) and b >= full.index(key) + len(key) for _, a, b in secret_scan.find(full)[1])


def test_urls_end_to_end_and_short_candidates():
    for clean in ("https://example.net/" + "a/" * 400 + "A9fK2mQ8zL1vX7cB4nR6tY3wPq", "https://a.io/x?y=1&z=A9fK2mQ8zL1vX7cB4nR6tY3wPq"):
        assert secret_scan.find(clean) == ([], [])
    for key in ("k9-Qz7_Lm2-Xv8_Rt4-Bn6w", "k9-Qz7+Lm2/Xv8_Rt4Bn"):
        assert [k for k, *_ in secret_scan.find(f"see {key} here")[1]] == ["entropy"]


@pytest.mark.parametrize(("text", "kind", "hit"), [
    ("call +1 six three two 555 4827 ok", "phone", "+1 six three two 555 4827"),
    ("ip 10 dot 0 dot 0 dot 1 ok", "ip", "10 dot 0 dot 0 dot 1"),
    ("ip ten 10 dot zero dot 0 dot one", "ip", "10 dot zero dot 0 dot one"),
    ("mail jo at example.com now", "email", "jo at example.com"),
    ("x \U0001d423\U0001d428@\U0001d41e\U0001d431.\U0001d41c\U0001d428\U0001d426", "email", "\U0001d423\U0001d428@\U0001d41e\U0001d431.\U0001d41c\U0001d428\U0001d426"),
    ("+\u09e7 \u09ec\u09e9\u09e8 \u09eb\u09eb\u09eb \u09ea\u09ee\u09e8\u09ed", "phone", "+\u09e7 \u09ec\u09e9\u09e8 \u09eb\u09eb\u09eb \u09ea\u09ee\u09e8\u09ed"),
    ("\u0e51\u0e50.0.0.\u0e51", "ip", "\u0e51\u0e50.0.0.\u0e51"),
    ("+１ 632 555 4827 0000 one", "phone", "+１ 632 555 4827 0000"),
])
def test_short_and_other_disguises(text, kind, hit):
    at = text.index(hit)
    assert (kind, at, at + len(hit)) in pii.find(text)[1]
    assert hit not in pii.mask(text)


@pytest.mark.parametrize("text", ["we meet at 5.30 today", "one of two at home", "the dot 3 dot plot", "look at this. Then"])
def test_words_that_are_no_disguise(text):
    assert pii.find(text) == ([], [])


def test_occurrences_in_flat_arrays_equal_the_heap(monkeypatch):
    """every occurrence has the ids of the heap, also when the table of units overflows and starts again."""
    import zlib

    import numpy as np

    monkeypatch.setattr(pieces, "KNOWN", 12)
    monkeypatch.setattr(pieces, "OCCURRENCES", 7)
    voc, known = pieces.load(), pieces.Known()
    texts = ["the quick brown fox the fox", "", "the \u2581 na\u00efve \U0001f600x \U0001f600x fox\n\nfox  " + "ab" * 40, "quick " * 9, " ".join(f"word{i % 17} the" for i in range(40))]
    for dropout in (0.0, 0.4):
        for _ in range(2):
            ids, counts = pieces.encode_flat(texts, voc, dropout, 3, [1, 2, 3, None, 5], known)
            want = []
            for d, t in zip([1, 2, 3, None, 5], texts, strict=True):
                units = pieces.UNIT.findall(" " + t) if t else []
                base = pieces.occurrence(np.full(len(units), zlib.crc32(f"3:{d}".encode()), dtype=np.uint64), np.arange(len(units)))
                want.append([i for u, b in zip(units, base.tolist(), strict=True) for i in pieces.segment(u, voc, dropout, 0, b)])
            assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
            assert pieces.lossless(texts, ids, counts, voc) == [True] * 5
    ids, counts = pieces.encode_flat(texts, voc, 0.0, 0, [0] * 5, known)
    assert pieces.lossless(["another", *texts[1:]], ids, counts, voc) == [False, True, True, True, True]
    assert [len(x) for x in pieces.encode_flat([], voc, 0.1, 0, [], known)] == [0, 0]


def test_workers_hand_back_what_they_freed():
    """memory of the last task or owner goes back to the system, also below blocks that stay."""
    import subprocess
    import sys

    code = """
import resource
from triage.llm.common import process_cache, thin

def mb():
    return int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize() >> 20

def fill():
    return [b"x" * 100_000 for _ in range(2000)]

process_cache("one")["held"] = fill()
stays = [b"y" * 100_000]
a = mb()
process_cache("two")
b = mb()
held = fill()
stays.append(b"z" * 100_000)
c = mb()
del held
list(thin([]))
print(a - b, c - mb())
"""
    root = __file__.rsplit("/tests/", 1)[0]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert all(int(x) > 150 for x in out.split()), out
