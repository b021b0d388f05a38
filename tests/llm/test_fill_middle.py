"""Learned rank index against plain lists; cuts, forms and round trips against slicing."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from triage.llm import fill_middle
from triage.llm.fill_middle import boundaries, fit_index, rearrange, restored, transform


def plain_units(text, unit):
    """Units by a loop over code points."""
    out = []
    for i, c in enumerate(text):
        space = c in " \t\n\x0b\x0c\r"
        before = text[i - 1] if i else ""
        new = {"char": True, "line": before == "\n", "word": not space and before != "" and before in " \t\n\x0b\x0c\r"}[unit]
        if new or not out:
            out.append("")
        out[-1] += c
    return out


@pytest.mark.parametrize("unit", ["char", "word", "line"])
@pytest.mark.parametrize("error", [1, 7, 120])
def test_index_gives_every_boundary(unit, error):
    rng = random.Random(error)
    for _ in range(60):
        text = "".join(rng.choice("ab c\n é漢😀 \t") for _ in range(rng.choice([0, 1, 2, 50, 3000])))
        want = np.cumsum([0, *(len(u.encode()) for u in plain_units(text, unit))])
        y = boundaries(np.frombuffer(text.encode(), dtype=np.uint8), unit)
        assert y.tolist() == want.tolist()
        index = fit_index(y, error)
        assert [index[i] for i in range(len(y))] == y.tolist()
        assert abs(index.residual.astype(int)).max() <= error + 1


def test_few_segments_for_even_text():
    y = boundaries(np.frombuffer(("abc déf 漢字 " * 20_000).encode(), dtype=np.uint8), "char")
    assert len(fit_index(y).start) == 1
    mixed = boundaries(np.frombuffer(("a" * 5000 + "漢" * 5000 + "b" * 5000).encode(), dtype=np.uint8), "char")
    assert 2 <= len(fit_index(mixed).start) <= 4


TEXTS = [None, "", "a", "<P>", "x <S> y", "x <M", "<P", "S>", "é", "😀" * 500, "word one two\nthree  four\n" * 40, "<" * 50, ">" * 50, "z" * 400_000]


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_against_slicing(spark, unit):
    rows = [(i, t) for i, t in enumerate(TEXTS * 40)] + [(None, "no id here"), (3, "a"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n", "form", "output", "prefix_units")})
    got = transform(df, unit=unit).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = []
    for d, t in rows:
        t, units = t or "", plain_units(t or "", unit) if t is not None and len(t) < 10_000 else list(t or "") if unit == "char" else [t] if t else []
        h = hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
        i, j = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        if not t or h3 % 100 >= 90 or any(s in t for s in ("<P>", "<S>", "<M>")):
            want.append((d, len(units), "plain", None, None, t, t))
            continue
        p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
        want.append((d, len(units), "spm", i, j - i, f"<S>{s}<P>{p}<M>{m}", t) if h4 % 100 < 20 else (d, len(units), "psm", i, j - i, f"<P>{p}<S>{s}<M>{m}", t))
    key = lambda r: (str(r[0]), r[5])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_wrong_unit(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert transform(none).collect() == []
    with pytest.raises(ValueError):
        transform(none, unit="page")


def test_shares(monkeypatch):
    forms = [rearrange(b"some text", i, plain=0, spm=100)[1] for i in range(50)]
    assert set(forms) == {"spm"}
    assert {rearrange(b"some text", i, plain=100)[1] for i in range(50)} == {"plain"}
    assert rearrange(b"some text", 1, seed=1) != rearrange(b"some text", 1, seed=2)
    assert fill_middle.ERROR < 127
