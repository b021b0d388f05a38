"""Composite rules from rows against a brute-force evaluation of their JSON."""

import json
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from triage.operators.joins import contains_join
from triage.plans import composite
from triage.plans.composite import access, atom_hits, composite_rule_index, leaf_atoms, matching_rules, rule_tree

MAIL = ("message_id string, from_address string, from_domain string, sender_address string, reply_to_address string, subject string, "
        "precedence string, auto_submitted string, list_id string, to_count int, unsubscribe_link string")


def mails(rng, n):
    pick = lambda *xs: rng.choice(xs)
    return [(f"m{i}", f"{pick('Ann', 'bob', 'news')}{rng.randint(0, 30)}@{pick('a', 'b')}.example.com", pick("A.example.com", "b.example.com", None),
             pick(None, "r1@x", "r2@x"), pick(None, "", "q@y"), pick(None, "", "Daily report 1", "a_b%c", "REPORT", "x"), pick(None, "bulk", "list"),
             pick(None, "no"), None, rng.randint(0, 5), pick(None, "<x>")) for i in range(n)]


def value_of(row, field):
    r = dict(zip([x.split()[0] for x in MAIL.split(", ")], row))
    if field == "has_unsubscribe":
        return r["unsubscribe_link"] is not None
    v = r[field]
    return v.lower() if field == "from_domain" and v is not None else v


def ilike(text, pattern):
    import re
    return re.fullmatch("".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern.lower()), text.lower(), re.S) is not None


def holds(cond, row):
    if cond.get("type") in ("and", "or"):
        kids = [holds(x, row) for x in cond.get("all", cond.get("any"))]
        return all(kids) if cond["type"] == "and" else any(kids)
    v, op, w = value_of(row, cond["field"]), cond["op"], cond["value"]
    if v is None:
        return False
    if op in ("=", "!="):
        return (v == w) == (op == "=")
    if op == "in":
        return v in w
    if op in ("<=", "<", ">=", ">"):
        return {"<=": v <= w, "<": v < w, ">=": v >= w, ">": v > w}[op]
    if op == "ilike_any":
        return any(ilike(v, p) for p in w)
    return v.startswith(w) if op == "starts_with" else v.endswith(w)


def condition(rng, depth=0):
    if depth < 3 and rng.random() < (0.8 if depth == 0 else 0.35):
        kind = rng.choice(["and", "or"])
        return {"type": kind, "all" if kind == "and" else "any": [condition(rng, depth + 1) for _ in range(rng.randint(1, 3))]}
    text = ["from_address", "from_domain", "sender_address", "reply_to_address", "subject", "precedence"]
    op = rng.choice(["=", "!=", "in", "<=", ">", "<", ">=", "ilike_any", "starts_with", "ends_with", "has"])
    if op == "has":
        return {"field": "has_unsubscribe", "op": rng.choice(["=", "!="]), "value": rng.random() < 0.5}
    if op in ("<=", "<", ">=", ">"):
        return {"field": "to_count", "op": op, "value": rng.randint(0, 5)}
    values = ["bulk", "list", "r1@x", "", "Ann3@a.example.com", "bob7@b.example.com", "a.example.com", "x", "Daily report 1"]
    if op == "in":
        return {"field": rng.choice(text), "op": op, "value": rng.sample(values, rng.randint(1, 3))}
    if op == "ilike_any":
        return {"field": rng.choice(text), "op": op, "value": rng.sample(["%report%", "ann1%", "%@a.%", "%", "_", "%_b\\%c"[:3], "news%.com", "x"], rng.randint(1, 2))}
    if op in ("starts_with", "ends_with"):
        return {"field": rng.choice(text), "op": op, "value": rng.choice(["Ann", "bob1", ".com", "a.example.com", "", "Daily report 1 and more", "t 1"])}
    return {"field": rng.choice(text), "op": op, "value": rng.choice(values)}


def run(spark, mail, rules):
    m = spark.createDataFrame(mail, MAIL)
    r = spark.createDataFrame([(k, json.dumps(v)) for k, v in rules.items()], "rule_id string, condition_json string")
    return sorted(tuple(x) for x in matching_rules(m, r).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_nesting(spark, seed):
    rng = random.Random(seed)
    mail, rules = mails(rng, 60), {f"r{i}": condition(rng) for i in range(150)}
    want = sorted((m[0], k) for m in mail for k, v in rules.items() if holds(v, m))
    assert run(spark, mail, rules) == want and want


def test_ten_thousand_rules_by_their_rarest_condition(spark):
    rng = random.Random(7)
    mail = mails(rng, 200)
    rules = {f"r{i}": {"type": "and", "all": [{"field": "to_count", "op": "<=", "value": i % 5}, {"field": "precedence", "op": "!=", "value": "bulk"},
                                              {"field": "from_address", "op": "=", "value": f"Ann{i % 400}@a.example.com"}]} for i in range(10_000)}
    want = sorted((m[0], k) for m in mail for k, v in rules.items() if holds(v, m))
    assert run(spark, mail, rules) == want and want
    r = spark.createDataFrame([(k, json.dumps(v)) for k, v in rules.items()], "rule_id string, condition_json string")
    nodes, leaves, depth = rule_tree(r)
    atoms = leaf_atoms(leaves)
    words = spark.createDataFrame([("to_count", str(i), 40) for i in range(6)] + [("from_address", "Ann1@a.example.com", 1), ("precedence", "list", 90)],
                                  "field string, value string, n long")
    hits = atom_hits(words.select("field", "value"), atoms.select("field", "atom_op", "atom_value").distinct())
    cost = hits.join(words, ["field", "value"]).groupBy("field", "atom_op", "atom_value").sum("n").withColumnRenamed("sum(n)", "n")
    assert {x.field for x in access(nodes, leaves, atoms, cost, depth).collect()} == {"from_address"}


def test_no_rules_no_mail_and_wrong_rules(spark):
    rng = random.Random(3)
    assert run(spark, mails(rng, 5), {}) == []
    assert run(spark, [], {"r": condition(rng)}) == []
    assert run(spark, mails(rng, 5), {"r": {"field": "subject", "op": "in", "value": []}}) == []
    for bad in ({"field": "nothing", "op": "=", "value": 1}, {"field": "subject", "op": "~", "value": "x"}, {"type": "xor", "all": []}):
        with pytest.raises(PySparkException):
            run(spark, mails(rng, 5), {"r": bad})


def test_plan_has_no_cross_join(spark, fx001):
    p = composite_rule_index(fx001)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_candidates_are_neither_shuffled_nor_kept(spark):
    """What the common condition of many rules and many mails lets in is decided in the join that makes it."""
    rng = random.Random(11)
    mail = mails(rng, 300)
    rules = {f"r{i}": {"type": "and", "all": [{"field": "sender_address", "op": "=", "value": "r1@x"}, {"field": "to_count", "op": "!=", "value": i % 7},
                                              {"field": "subject", "op": "ilike_any", "value": ["%report%"] * (i % 2) + ["x"]}]} for i in range(400)}
    want = sorted((m[0], k) for m in mail for k, v in rules.items() if holds(v, m))
    m = spark.createDataFrame(mail, MAIL)
    r = spark.createDataFrame([(k, json.dumps(v)) for k, v in rules.items()], "rule_id string, condition_json string")
    out = matching_rules(m, r)
    assert sorted(tuple(x) for x in out.collect()) == want and len(want) > 5000
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = plan[:next(i for i, x in enumerate(plan) if "Join" in x)]
    assert any("told" in x for x in above) and not [x for x in above if re.search("Aggregate|LogicalRDD|Sort", x)]


def test_rows_of_a_rule_and_empty_nodes(spark):
    m = spark.createDataFrame([("a", *["x"] * 9, 1, None)[:9] + (1, None), (None, *["x"] * 8, 1, None), ("a", *["y"] * 8, 2, None)], MAIL)
    leaf = {"field": "subject", "op": "=", "value": "x"}
    rules = [("one", leaf, "p"), ("and", {"type": "and", "all": [leaf, {"type": "or", "any": []}]}, "q"), ("none", {"type": "and", "all": []}, "r")]
    r = spark.createDataFrame([(k, json.dumps(v), t) for k, v, t in rules], "rule_id string, condition_json string, target string")
    assert sorted(tuple(x) for x in matching_rules(m, r, keep=("target",)).collect()) == [("a", "and", "q"), ("a", "one", "p")]


def test_rules_that_say_the_same_are_decided_once(spark, monkeypatch):
    """What rules say is broken up and decided once, however many rules say it; rules that share it come in rows of bounded size."""
    rng = random.Random(13)
    mail = mails(rng, 40)
    said = [{"type": "and", "all": [{"field": "sender_address", "op": "=", "value": "r1@x"}, {"field": "to_count", "op": "!=", "value": k}]} for k in range(3)]
    said.append({"type": "or", "any": [said[0], {"field": "subject", "op": "ilike_any", "value": ["%report%"]}]})
    rules = {f"r{i:04}": said[i % 4] for i in range(1200)}
    seen = []
    monkeypatch.setattr(composite, "rule_tree", lambda df: seen.append(df.count()) or rule_tree(df))
    want = sorted((m[0], k) for m in mail for k, v in rules.items() if holds(v, m))
    assert run(spark, mail, rules) == want and want
    assert seen == [4]
    told = composite.shared_conditions(spark.createDataFrame([(k, json.dumps(v)) for k, v in rules.items()], "rule_id string, condition_json string"), ())[1]
    sizes = [len(x.told) for x in told.collect()]
    assert sum(sizes) == 1200 and max(sizes) == 256


def test_plain_rules_are_joined_without_steps(spark):
    """A condition that runs steps keeps a join from being compiled: only rules with nested conditions meet one."""
    leaf = {"field": "precedence", "op": "=", "value": "bulk"}
    rules = [("plain", {"type": "and", "all": [leaf, leaf]}), ("nested", {"type": "or", "any": [leaf, leaf]})]
    m = spark.createDataFrame(mails(random.Random(5), 20), MAIL)
    r = spark.createDataFrame([(k, json.dumps(v)) for k, v in rules], "rule_id string, condition_json string")
    plan = matching_rules(m, r)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [x for x in plan if "Join Inner" in x]
    assert len([x for x in joins if "aggregate(" in x]) == 1 and "aggregate(" not in joins[0]


def test_rows_that_come_twice(spark):
    """Mails of one id are one mail with the values of both; a rule's rows come once a row and condition."""
    m = spark.createDataFrame([("a", *["x"] * 8, 1, None), ("a", *["y"] * 8, 2, None), ("a", *["y"] * 8, 2, None)], MAIL)
    both = {"type": "and", "all": [{"field": "subject", "op": "=", "value": "x"}, {"field": "to_count", "op": ">=", "value": 2}]}
    rules = [("twice", both, "p"), ("twice", both, "q"), (None, both, "r"), ("once", both, "s")]
    r = spark.createDataFrame([(k, json.dumps(v), t) for k, v, t in rules], "rule_id string, condition_json string, target string")
    assert sorted(tuple(x) for x in matching_rules(m, r, keep=("target",)).collect()) == [
        ("a", "once", "s"), ("a", "twice", "p"), ("a", "twice", "p"), ("a", "twice", "q"), ("a", "twice", "q")]


def test_patterns_by_their_start_end_or_middle(spark):
    words = [(f, v) for f in ("subject", "from_address") for v in ("", "a", "Ann12345678@x", "ann1@x.com", "a_b", "axb", "50% off today", "re: a_b", "ÄRGER im büro", "x\ny")]
    likes = ["%", "_", "%%", "a%", "%A", "ann1234567%", "ann%", "%@x", "%n1@x%", "a\\_b", "%a\\_b", "a\\_b%", "50\\% off%", "%\\%%", "a_b", "%ärger%büro", "ärger im%", "%im b%", "x%y", ""]
    atoms = [(f, "ilike", p) for p in likes for f in ("subject", "from_address")][::-1][:-3]
    w, a = spark.createDataFrame(words, "field string, value string"), spark.createDataFrame(atoms, "field string, atom_op string, atom_value string")
    want = sorted(tuple(x) for x in w.join(a, "field").filter("value ilike atom_value").select("field", "value", "atom_op", "atom_value").collect())
    assert sorted(tuple(x) for x in atom_hits(w, a).collect()) == want and len(want) > 40


@pytest.mark.parametrize("gram", [1, 2, 4])
def test_contains_join_of_the_same(spark, gram):
    rng = random.Random(gram)
    texts = [(i, rng.choice("fg"), rng.choice([None, "", *("".join(rng.choice("abé.") for _ in range(rng.randint(0, 9))) for _ in range(8))])) for i in range(80)]
    many = [("g", "".join(rng.choice("abcdefghijklmnopqrstuvé") for _ in range(3)), 99) for _ in range(200)]  # more starts than are told apart
    for extra in ([], many):
        pats = [(rng.choice("fgh"), rng.choice([None, "", "a", "ab", "aba", "é.a", "abab.", "b"]), k) for k in range(12)] + extra
        got = contains_join(spark.createDataFrame(texts, "i int, f string, t string"), "t", spark.createDataFrame(pats, "f string, p string, k int"), "p", gram, same="f")
        assert sorted(tuple(r) for r in got.select("i", "f", "t", "p", "k").collect()) == sorted(
            (i, f, t, p, k) for i, f, t in texts for g, p, k in pats if f == g and t is not None and p and p in t)


def test_wide_doors_are_dealt_in_pieces(spark):
    """A door that lets many pairs in is joined in pieces, each pair once; the mails are not dealt by bytes."""
    mails_in = spark.createDataFrame([(f"m{i}", [], 1 if i % 5 else 2) for i in range(60)], "message_id string, matched array<bigint>, atom long")
    by_door = spark.createDataFrame([(a, [], [], [(f"r{a}{k}",)]) for a in (1, 2) for k in range(10)],
                                    "atom long, must array<bigint>, mustnt array<bigint>, told array<struct<rule_id:string>>")
    out = composite.spread_join(mails_in, by_door, spark.createDataFrame([(1, 48), (2, 12)], "atom long, n long"), piece=120)
    got = [tuple(x) for x in out.select("message_id", F.col("told")[0]["rule_id"]).collect()]
    assert sorted(got) == sorted((f"m{i}", f"r{1 if i % 5 else 2}{k}") for i in range(60) for k in range(10))
    assert {x.atom: x.n for x in out.groupBy("atom").agg(F.count_distinct("piece").alias("n")).collect()} == {1: 4, 2: 1}
