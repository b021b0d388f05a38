"""Composite rules from rows, decided through a predicate index (B13, K26's ``condition_json``).

A rule table holds and/or conditions as JSON, nested to any depth. They are never compiled into
columns, so the plan is the same for four rules and for a million:

1. ``rule_tree``: conditions are broken up into nodes, one level a pass over the rule table, and
   their leaves into *atoms* (field, op, value), shared by all rules that state them.
2. ``atom_hits``: the distinct values of each field are a dictionary with counts; atoms meet it by
   equi-joins (``=``, ``in``; ends by suffix; ``like`` by its literal pieces), ranges by comparing the
   distinct numbers with the distinct thresholds. Each mail then has its matched atoms.
3. ``access``: the counts say how many mails an atom matches. An ``or`` is found through all its
   children, an ``and`` through the cheapest one alone: these access leaves turn matched atoms into
   candidates (mail, rule).
4. ``programs`` and ``decide``: the candidates' other leaves are looked up among the mail's matched
   atoms, and nodes are decided from the leaves up, in the row that the join of mails and rules makes;
   candidates are neither shuffled nor kept.

So work follows the candidates of each rule's rarest condition; a rule that only says what a mail
must not be has almost all mail as candidates, as it matches almost all.

Null values satisfy no leaf, ``!=`` included. Unknown fields, operators or broken JSON are errors.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triage.operators.joins import contains_join
from triage.plans.gateway import SEED_CONDITIONS
from triage.registry import register
from triage.session import checkpoint_dir

c = F.col

# mail columns that conditions may name, as text
FIELDS = {
    **{x: x for x in ("from_address", "sender_address", "reply_to_address", "subject", "precedence", "auto_submitted", "list_id")},
    "from_domain": "lower(from_domain)", "to_count": "cast(to_count as string)",
    "has_unsubscribe": "cast(unsubscribe_link is not null as string)",
}
RANGES = ("<=", "<", ">=", ">")
OPS = ("=", "!=", "in", *RANGES, "starts_with", "ends_with", "ilike_any")
NOT_NULL = "not null"  # the atom behind ``!=``: the field has a value


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _or_error(ok: Column, value: Column, message: str, kind: str = "string") -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)).cast(kind))


def rule_tree(rules: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(inner nodes, leaves, depth) of ``rules(rule_id, condition_json)``.

    Nodes: rule_id, node (its path, of ten digits a level), parent, level, kind (and/or). Leaves: rule_id, node, parent,
    level, field, op, values (texts). The loop runs once a level of the deepest condition.
    """
    nodes, leaves, level = None, None, 0
    get = lambda path, kind: F.try_variant_get("v", path, kind)

    def read(front):  # each node is looked through once
        inner = F.coalesce(c("kind").isin("and", "or"), F.lit(False))
        at = front.withColumn("kind", get("$.type", "string"))
        values = F.coalesce(get("$.value", "array<string>"), F.array(get("$.value", "string")))
        field, op = get("$.field", "string"), get("$.op", "string")
        return _cut(at.select(
            "rule_id", "node", "parent", F.lit(level).alias("level"), "kind", inner.alias("inner"),
            F.when(~inner, _or_error(F.coalesce(field.isin(list(FIELDS)), F.lit(False)), field, "a condition names an unknown field")).alias("field"),
            F.when(~inner, _or_error(F.coalesce(op.isin(list(OPS)), F.lit(False)), op, "a condition has an unknown operator")).alias("op"),
            F.when(~inner, F.filter(values, lambda x: x.isNotNull())).alias("values"),
            F.when(inner, F.coalesce(get("$.all", "array<variant>"), get("$.any", "array<variant>"))).alias("children")))

    front = read(rules.select("rule_id", F.lit("0").alias("node"), F.lit(None).cast("string").alias("parent"),
                              F.parse_json("condition_json").alias("v")))
    while not front.isEmpty():
        named = front.filter("inner").select("rule_id", "node", "parent", "level", "kind")
        leaf = front.filter("not inner").select("rule_id", "node", "parent", "level", "field", "op", "values")
        nodes = named if nodes is None else nodes.unionByName(named)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        level += 1
        front = read(front.filter("inner").select("rule_id", c("node").alias("parent"), F.posexplode("children").alias("pos", "v"))
                     .select("rule_id", F.concat_ws(".", "parent", F.lpad(c("pos").cast("string"), 10, "0")).alias("node"), "parent", "v"))
    if nodes is None:
        empty = rules.sparkSession.createDataFrame
        return (empty([], "rule_id string, node string, parent string, level int, kind string"),
                empty([], "rule_id string, node string, parent string, level int, field string, op string, values array<string>"), 0)
    return _cut(nodes), _cut(leaves), level


def leaf_atoms(leaves: DataFrame) -> DataFrame:
    """Leaves with their atoms: rule_id, node, field, atom_op, atom_value, absent.

    A leaf holds if one of its atoms does; ``!=`` holds if the field has a value and the atom of the
    unwanted value (``absent``) doesn't match.
    """
    atom = lambda op, value, absent=False: F.struct(op.alias("atom_op"), value.alias("atom_value"), F.lit(absent).alias("absent"))
    op = F.when(c("op") == "in", "=").when(c("op") == "ilike_any", "ilike").otherwise(c("op"))
    plain = F.transform("values", lambda v: atom(op, v))
    unequal = F.concat(F.array(atom(F.lit(NOT_NULL), F.lit(""))), F.transform("values", lambda v: atom(F.lit("="), v, True)))
    return leaves.select("rule_id", "node", "field", F.explode(F.when(c("op") == "!=", unequal).otherwise(plain)).alias("a")).select(
        "rule_id", "node", "field", "a.*")


def field_rows(mail: DataFrame, fields: list[str]) -> DataFrame:
    """(message_id, field, value) of the fields that rules name, without nulls."""
    wide = mail.select("message_id", *[F.expr(FIELDS[f]).alias(f) for f in fields])
    return wide.unpivot(["message_id"], fields, "field", "value").filter("value is not null")


def _by_end(words: DataFrame, atoms: DataFrame, op: str, gram: int = 8, text: str = "value", part: str = "atom_value") -> DataFrame:
    """Values whose ``text`` starts or ends with an atom's ``part``: equi-join on so many first or last characters."""
    end = (lambda x, n: F.substring(x, 1, n)) if op == "starts_with" else (lambda x, n: F.right(x, n))
    index = atoms.filter(c(part) != "").withColumn("_end", end(c(part), F.lit(gram)))
    lens = index.groupBy("field").agg(F.collect_set(F.length("_end")).alias("_lens"))  # a row a field, of at most ``gram`` numbers
    ends = words.join(F.broadcast(lens), "field").select(
        "*", F.explode_outer(F.transform(F.filter("_lens", lambda n: n <= F.length(text)), lambda n: end(c(text), n))).alias("_end"))
    whole = F.startswith(text, part) if op == "starts_with" else F.endswith(text, part)
    return ends.join(index, ["field", "_end"]).filter(whole).select("field", "value", "atom_op", "atom_value")


def _by_pattern(words: DataFrame, atoms: DataFrame, gram: int = 8) -> DataFrame:
    """Values that match an atom's pattern, found through the literal piece at its start or end, or else its longest one."""
    # eight characters: rules often differ behind a common start
    likes = (atoms.filter("atom_op = 'ilike'").withColumn("_pieces", F.split(F.lower("atom_value"), r"[%_\\]+"))
             .withColumns({"_piece": F.array_max(F.transform("_pieces", lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"],
                           "_head": F.element_at("_pieces", 1), "_tail": F.element_at("_pieces", -1)}))
    enough = F.least(F.length("_piece"), F.lit(gram))  # such a piece tells no less than the longest
    by = F.when(c("_piece") == "", "free").when(F.length("_head") >= enough, "_head").when(F.length("_tail") >= enough, "_tail").otherwise("_piece")
    likes = likes.withColumn("_by", by).drop("_pieces")
    texts = words.select("field", "value", F.lower("value").alias("_low"))
    found = [_by_end(texts, likes.filter("_by = '_head'"), "starts_with", gram, "_low", "_head"),
             _by_end(texts, likes.filter("_by = '_tail'"), "ends_with", gram, "_low", "_tail"),
             contains_join(texts, "_low", likes.filter("_by = '_piece'"), "_piece", gram, same="field"),
             words.join(likes.filter("_by = 'free'"), "field")]  # only wildcards
    cols = ["field", "value", "atom_op", "atom_value"]
    out = found[0].select(cols)
    for x in found[1:]:
        out = out.unionByName(x.select(cols))
    return out.filter(F.expr("value ilike atom_value"))


def atom_hits(words: DataFrame, atoms: DataFrame) -> DataFrame:
    """(field, value, atom_op, atom_value) of every distinct value and distinct atom that it matches."""
    cols = ["field", "value", "atom_op", "atom_value"]
    equal = words.join(atoms.filter("atom_op = '='").withColumn("value", c("atom_value")), ["field", "value"])
    present = words.join(F.broadcast(atoms.filter(c("atom_op") == NOT_NULL)), "field")  # one a field
    ranges = atoms.filter(c("atom_op").isin(list(RANGES))).withColumn("_t", F.expr("try_cast(atom_value as double)"))
    among = ranges.agg(F.collect_set("field"))  # one row of at most len(FIELDS) names; other fields' texts are not read as numbers
    numbers = words.withColumn("_among", among.scalar()).withColumn(
        "_x", F.when(F.array_contains("_among", c("field")), F.expr("try_cast(value as double)"))).filter("_x is not null").drop("_among")
    compare = F.expr("case atom_op when '<=' then _x <= _t when '<' then _x < _t when '>=' then _x >= _t else _x > _t end")
    ranged = numbers.join(ranges, "field").filter(compare)
    ended = [_by_end(words, atoms.filter(c("atom_op") == op), op) for op in ("starts_with", "ends_with")]
    empty = words.join(F.broadcast(atoms.filter(c("atom_op").isin("starts_with", "ends_with") & (c("atom_value") == ""))), "field")
    out = equal.select(cols)
    for x in (present, ranged, *ended, empty, _by_pattern(words, atoms)):
        out = out.unionByName(x.select(cols))
    return out


def programs(nodes: DataFrame, leaves: DataFrame, atoms: DataFrame, kind: str = "bigint") -> DataFrame:
    """(rule_id, copies, program, must, mustnt, simple, doors): each rule's tree as one row, children before their parent.

    ``atoms`` are those of ``leaf_atoms`` with ``atom`` (an id, of the type ``kind``) and ``n``, the mails it
    matches. A step is a leaf with the atoms of which one must hold (``some``) and of those that must not
    (``none``), or a node with the number of its children. ``must`` and ``mustnt`` are the atoms that leaves
    right below an outer ``and`` ask for alone; they are looked at first, and a ``simple`` rule has no other
    conditions. ``doors``: the atoms through which the rule's candidates come. ``copies`` counts the rule's rows.

    Leaves, nodes and atoms are dealt by rule once; a rule's steps never leave its partition.
    """
    part = lambda df, **cols: df.select("rule_id", *[
        (cols[x] if x in cols else F.lit(None)).cast(t).alias(x)
        for x, t in (("node", "string"), ("parent", "string"), ("kind", "string"), ("root", "int"), ("kid", "string"),
                     ("some", kind), ("none", kind), ("n", "bigint"))])
    tree = leaves.select("rule_id", "node", "parent", "level", F.lit("leaf").alias("kind")).unionByName(nodes.select("rule_id", "node", "parent", "level", "kind"))
    rows = part(tree, node=c("node"), parent=c("parent"), kind=c("kind"), root=(c("level") == 0)).unionAll(
        part(tree.filter("parent is not null"), node=c("parent"), kid=c("node"))).unionAll(
        part(atoms, node=c("node"), some=F.when(~c("absent"), c("atom")), none=F.when(c("absent"), c("atom")), n=F.when(~c("absent"), c("n"))))
    has = {x: f"is_{x}" for x in ("and", "leaf", "or")}
    steps = rows.filter("rule_id is not null").repartition("rule_id").groupBy("rule_id", "node").agg(
        F.max("parent").alias("parent"), *[F.coalesce(F.bool_or(c("kind") == x), F.lit(False)).alias(y) for x, y in has.items()],
        F.sum("root").alias("roots"), F.size(F.collect_set("kid")).alias("kids"),
        F.collect_set("some").alias("some"), F.collect_set("none").alias("none"), F.coalesce(F.sum("n"), F.lit(0)).alias("cost"))
    # '~' sorts behind '.', so a parent comes behind all that is below it
    step = lambda x: F.array(F.struct(F.concat("node", F.lit("~")).alias("place"), F.lit(x).alias("kind"), "kids", "some", "none", "cost", "node"))
    step = F.concat(*[F.slice(step(x), 1, F.when(c(y), 1).otherwise(0)) for x, y in has.items()])
    top = c("parent").isNull() | (c("parent") == "0")
    of = lambda when, ids: F.flatten(F.collect_list(F.when(when & c("is_leaf"), c(ids))))
    alone = F.size("some") == 1
    gathered = steps.groupBy("rule_id").agg(
        F.sort_array(F.flatten(F.collect_list(step))).alias("program"), F.sum("roots").cast("int").alias("copies"),
        F.bool_or((c("node") == "0") & c("is_and")).alias("outer"),  # of an outer ``or``, no leaf is asked for alone
        of(c("parent").isNull() & alone, "some").alias("m0"), of((c("parent") == "0") & alone, "some").alias("m1"),
        of(c("parent").isNull(), "none").alias("x0"), of(c("parent") == "0", "none").alias("x1"),
        F.min_by("some", F.when(c("is_leaf"), F.struct("cost", "node"))).alias("cheapest"),
        F.bool_and((~c("is_leaf") | top & alone) & (~c("is_and") | c("parent").isNull() & (c("kids") > 0)) & ~c("is_or")).alias("simple"))
    both = lambda a, b: F.array_distinct(F.when(c("outer"), F.concat(a, b)).otherwise(c(a)))
    return gathered.select("rule_id", "copies", F.transform("program", lambda x: x.dropFields("place", "cost", "node")).alias("program"),
                           both("m0", "m1").alias("must"), both("x0", "x1").alias("mustnt"), "simple",
                           F.when(c("simple"), c("cheapest")).otherwise(entry_atoms(c("program"), kind)).alias("doors"))


def entry_atoms(program: Column, kind: str) -> Column:
    """The atoms through which a rule's candidates come. Costs go up the steps: an ``or`` is found through all
    its children and costs their sum, an ``and`` through its cheapest child alone. A node without children has none."""
    def step(stack, x):
        below = F.size(stack) - x["kids"]
        kids = F.array_compact(F.slice(stack, below + 1, x["kids"]))
        every = F.struct(F.aggregate(kids, F.lit(0).cast("bigint"), lambda a, k: a + k["cost"]).alias("cost"), x["node"].alias("node"),
                         F.flatten(F.transform(kids, lambda k: k["doors"])).alias("doors"))
        least = F.struct(F.array_min(kids)["cost"].alias("cost"), x["node"].alias("node"), F.array_min(kids)["doors"].alias("doors"))
        node = F.when(F.size(kids) > 0, F.when(x["kind"] == "and", least).otherwise(every))
        leaf = F.struct(x["cost"].alias("cost"), x["node"].alias("node"), x["some"].alias("doors"))
        return F.when(x["kind"] == "leaf", F.concat(stack, F.array(leaf))).otherwise(
            F.concat(F.slice(stack, F.lit(1), below), F.array(node)))

    start = F.array().cast(f"array<struct<cost:bigint,node:string,doors:array<{kind}>>>")
    return F.array_distinct(F.aggregate(program, start, step)[0]["doors"])


def access(nodes: DataFrame, leaves: DataFrame, atoms: DataFrame, cost: DataFrame, depth: int) -> DataFrame:
    """(rule_id, field, atom_op, atom_value): the atoms through which each rule's candidates come."""
    used = ["field", "atom_op", "atom_value"]
    priced = atoms.join(cost, used, "left").withColumn("atom", F.struct(*used))
    return programs(nodes, leaves, priced, "struct<field:string,atom_op:string,atom_value:string>").select(
        "rule_id", F.explode("doors").alias("door")).select("rule_id", "door.*")


def decide(program: Column, matched: Column) -> Column:
    """Whether a rule holds for a mail with these matched atoms: its steps run over a stack of truths.
    A node without children has no truth, and its parent goes by the others."""
    def step(stack, x):
        below = F.size(stack) - x["kids"]
        kids = F.array_compact(F.slice(stack, below + 1, x["kids"]))
        node = F.when(F.size(kids) > 0, F.when(x["kind"] == "and", ~F.array_contains(kids, False)).otherwise(F.array_contains(kids, True)))
        leaf = F.arrays_overlap(x["some"], matched) & ~F.arrays_overlap(x["none"], matched)
        return F.when(x["kind"] == "leaf", F.concat(stack, F.array(leaf))).otherwise(
            F.concat(F.slice(stack, F.lit(1), below), F.array(node)))

    return F.coalesce(F.aggregate(program, F.array().cast("array<boolean>"), step)[0], F.lit(False))


def shared_conditions(rules: DataFrame, keep: tuple[str, ...], chunk: int = 256) -> tuple[DataFrame, DataFrame]:
    """(conditions, told): what rules say, once for all rules that say the same.

    Conditions: condition_json under the least of those rules' ids as ``rule_id`` (rules without an id stay
    as they are). Told: that rule_id with its rules' rows (rule_id and the columns ``keep``), up to
    ``chunk`` rules a row.
    """
    rows = F.collect_list(F.struct("rule_id", *keep)) if keep else F.array(F.struct("rule_id"))
    by_rule = rules.filter("rule_id is not null").groupBy("rule_id").agg(
        F.sort_array(F.collect_list(F.struct("condition_json"))).alias("said"), rows.alias("told"))
    alike = Window.partitionBy("hash", "said").orderBy("rule_id")  # the hash first: it is compared faster than texts
    ranked = _cut(by_rule.withColumn("hash", F.xxhash64("said")).withColumns({"first": F.first("rule_id").over(alike), "place": F.row_number().over(alike) - 1}))
    conditions = ranked.filter("place = 0").select("rule_id", F.explode("said").alias("x")).select("rule_id", "x.condition_json")
    told = ranked.groupBy(c("first").alias("rule_id"), F.floor(c("place") / chunk).alias("chunk")).agg(
        F.flatten(F.collect_list("told")).alias("told")).drop("chunk")
    return conditions.unionByName(rules.filter("rule_id is null").select("rule_id", "condition_json")), told


def mail_atoms(mail: DataFrame, value_atoms: DataFrame, fields: list[str], small: int = 100_000) -> DataFrame:
    """(message_id, matched, plain, nested): the atoms of each mail's values, and those of them that are doors of such rules.

    ``value_atoms`` (field, value and the same) is looked up once a field; the fields whose values and atoms
    are counted ``small`` are broadcast, so a mail is shuffled for the others and for its id only.
    """
    kinds = ("matched", "plain", "nested")
    sizes = {r.field: r.n for r in value_atoms.groupBy("field").agg(F.sum(F.size("matched") + 1).alias("n")).collect()}  # a row a field
    wide = mail.filter("message_id is not null").select("message_id", *[F.expr(FIELDS[f]).alias(f) for f in fields])
    of = {f: value_atoms.filter(c("field") == f).select(c("value").alias(f), *[c(x).alias(f"{x}_{f}") for x in kinds])
          for f in sizes}
    for f in sorted(of, key=lambda f: -sizes[f]):
        wide = wide.join(F.broadcast(of[f]) if sizes[f] <= small else of[f], f, "left")
    none = F.array().cast("array<bigint>")
    wide = wide.select("message_id", *[F.concat(none, *[F.coalesce(f"{name}_{f}", none) for f in of]).alias(name) for name in kinds])
    flat = lambda x: F.when(F.size("all") == 1, F.get("all", F.lit(0))[x]).otherwise(F.array_distinct(F.flatten(c("all")[x]))).alias(x)
    return wide.repartition("message_id").groupBy("message_id").agg(F.collect_list(F.struct(*kinds)).alias("all")).select(
        "message_id", *[flat(x) for x in kinds])


def _quick(must: str, mustnt: str, matched: str, n: int = 4) -> Column:
    """All of ``must`` and none of ``mustnt`` are matched: the first ``n`` are looked up one by one, without a set made for each pair."""
    ok = F.lit(True)
    for k in range(n):
        has = lambda ids, k=k: F.array_contains(matched, F.get(ids, F.lit(k)))
        ok = ok & ((F.size(must) <= k) | has(must)) & ((F.size(mustnt) <= k) | ~has(mustnt))
    return ok & ((F.size(must) <= n) | (F.size(F.array_except(must, matched)) == 0)) & (
        (F.size(mustnt) <= n) | ~F.arrays_overlap(mustnt, matched))


def spread_join(mails: DataFrame, by_door: DataFrame, cost: DataFrame, piece: int = 5_000_000) -> DataFrame:
    """Inner join on ``atom``; a door that lets more than ``piece`` pairs of mail and rule in is dealt in pieces of about that many.

    Pairs, not bytes, say what a task has to do: few mails meet many rules behind one door, so partitions are not
    put together by their size either.
    """
    pairs = by_door.groupBy("atom").agg(F.sum(F.size("told")).alias("rules")).join(cost, "atom")
    wide = _cut(pairs.select("atom", F.ceil(c("n") * c("rules") / piece).cast("int").alias("pieces")).filter("pieces > 1"))
    wide = F.broadcast(wide)  # no more doors than pairs / piece
    parts = int(mails.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = F.coalesce("pieces", F.lit(1))
    left = mails.join(wide, "atom", "left").withColumn("piece", F.pmod(F.xxhash64("message_id"), pieces).cast("int")).drop("pieces")
    right = by_door.join(wide, "atom", "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces")
    return left.repartition(parts, "atom", "piece").join(right, ["atom", "piece"])


def matching_rules(mail: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(message_id, rule_id) of every mail and composite rule that holds for it, with the rule's columns ``keep``.

    What is shuffled and kept grows with mails, values, atoms and rules: candidates are decided where the
    join makes them, once for all rules that say the same, and only those that hold leave it.
    """
    said, told = shared_conditions(rules, keep)
    nodes, leaves, depth = rule_tree(said)
    atoms = _cut(leaf_atoms(leaves))
    fields = [r.field for r in atoms.select("field").distinct().collect()]  # at most len(FIELDS)
    if not fields:
        return mail.select("message_id").limit(0).crossJoin(rules.select("rule_id", *keep).limit(0))
    rows = field_rows(mail, sorted(fields))
    words = _cut(rows.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")))
    used = ["field", "atom_op", "atom_value"]
    named = _cut(atoms.select(used).distinct().withColumn("atom", F.monotonically_increasing_id()))
    hits = _cut(atom_hits(words.select("field", "value"), named.select(used)).join(named, used).select("field", "value", "atom"))
    cost = _cut(hits.join(words, ["field", "value"]).groupBy("atom").agg(F.sum("n").alias("n")))
    priced = atoms.join(named.join(cost, "atom", "left"), used).drop("field", "atom_op", "atom_value")
    # conditions come with their programs and rules through each of their doors
    whole = programs(nodes, leaves, priced).join(told, "rule_id")
    by_door = _cut(whole.select(
        F.explode_outer("doors").alias("atom"),  # outer: else a filter would choose the doors again
        *[F.when(~c("simple"), c(x)).alias(y) for x, y in (("doors", "all_doors"), ("program", "program"))],
        "must", "mustnt", "simple", F.flatten(F.array_repeat("told", c("copies"))).alias("told"))
        .withColumn("must", F.array_remove("must", c("atom"))))
    # each distinct value's atoms, then each mail's; doors: those of them through which candidates come
    doors = by_door.groupBy("atom").agg(F.bool_or("simple").alias("to_plain"), F.bool_or(~c("simple")).alias("to_nested"))
    value_atoms = _cut(hits.join(doors, "atom", "left").groupBy("field", "value").agg(
        F.collect_set("atom").alias("matched"), *[F.collect_set(F.when(c(f"to_{x}"), c("atom"))).alias(x) for x in ("plain", "nested")]))
    mails = mail_atoms(mail, value_atoms, sorted(fields))
    # apart: programs run step by step, and a join that runs them is not compiled; the bulk of the pairs is plain
    plain = spread_join(mails.select("message_id", "matched", F.explode("plain").alias("atom")),
                        by_door.filter("simple").select("atom", "must", "mustnt", "told"), cost).filter(_quick("must", "mustnt", "matched"))
    # of the doors that let a rule in, the first one counts
    first = F.array_min(F.array_intersect("all_doors", "nested")) == c("atom")
    nested = (mails.select("message_id", "matched", "nested", F.explode("nested").alias("atom")).join(by_door.filter("not simple").drop("simple"), "atom")
              .filter(first & _quick("must", "mustnt", "matched") & decide(c("program"), c("matched"))))
    tell = lambda df: df.select("message_id", F.explode("told").alias("told")).select("message_id", "told.*")
    return tell(plain).unionByName(tell(nested))


# --- the registered query: a rule a customer, and the seed rules --------------------------------

def composite_rule_rows(fx) -> DataFrame:
    """(rule_id, target_category, condition_json): rules of four shapes from customer numbers, and the seeds."""
    n = c("n")
    leaf = lambda field, op, value: F.struct(F.lit(field).alias("field"), F.lit(op).alias("op"), value.alias("value"))
    text = lambda form, *parts: F.format_string(form, *parts)
    every = lambda *xs: F.concat(F.lit('{"type":"and","all":['), F.concat_ws(",", *map(F.to_json, xs)), F.lit("]}"))
    address = F.array(text("ann%d@%%", n), text("%%<u%d.p@%%", n))
    shape0 = every(leaf("from_address", "ilike_any", address), leaf("precedence", "!=", F.lit("bulk")), leaf("to_count", "<=", n % 5 + 1))
    inner = every(leaf("from_address", "starts_with", text("U%d.p+", n)), leaf("has_unsubscribe", "=", F.lit(False)),
                  leaf("subject", "ilike_any", F.array(text("%%nr %d", n % 13))))
    shape1 = F.concat(F.lit('{"type":"or","any":['), F.to_json(leaf("from_address", "=", text("News%d+view@D%d.Example.com", n, n % 23))),
                      F.lit(","), inner, F.lit("]}"))
    either = F.array(text("Ann%d@D%d.Example.com", n, n % 23), text("News%d+click@D%d.Example.com", n, n % 23))
    shape2 = every(leaf("from_domain", "ends_with", text("d%d.example.com", n % 23)), leaf("from_address", "in", either),
                   leaf("to_count", ">=", F.lit(2)))
    shape3 = every(leaf("reply_to_address", "ilike_any", F.array(text("reply%d+x@r%d.%%", n % 19, n % 23))),
                   leaf("sender_address", "!=", text("relay%d@hub.example.com", n % 17)), leaf("subject", "!=", text("view Report, nr %d", n % 13)))
    shape = F.when(n % 4 == 0, shape0).when(n % 4 == 1, shape1).when(n % 4 == 2, shape2).otherwise(shape3)
    own = fx.table("customer").select(c("c_custkey").cast("int").alias("n")).select(
        F.format_string("C%d", n).alias("rule_id"), F.concat(F.lit("shape"), (n % 4).cast("string")).alias("target_category"),
        shape.alias("condition_json"))
    seeds = fx.spark.createDataFrame([(f"SEED_{k}", k, json.dumps(v)) for k, v in SEED_CONDITIONS.items()], own.schema)
    return own.unionByName(seeds)


def _sql_rule_index() -> str:
    from triage.plans.gateway import compile_condition_sql
    seeds = " union all ".join(f"select message_id, 'SEED_{k}' as rule_id, '{k}' as target_category from mail "
                               f"where coalesce({compile_condition_sql(v)}, false)" for k, v in SEED_CONDITIONS.items())
    shapes = [
        "(m.from_address ilike 'ann' || n || '@%' or m.from_address ilike '%<u' || n || '.p@%') and m.precedence <> 'bulk' and m.to_count <= n % 5 + 1",
        "m.from_address = 'News' || n || '+view@D' || (n % 23) || '.Example.com' or (starts_with(m.from_address, 'U' || n || '.p+') "
        "and m.unsubscribe_link is null and m.subject ilike '%nr ' || (n % 13))",
        "ends_with(lower(m.from_domain), 'd' || (n % 23) || '.example.com') and m.to_count >= 2 and m.from_address in "
        "('Ann' || n || '@D' || (n % 23) || '.Example.com', 'News' || n || '+click@D' || (n % 23) || '.Example.com')",
        "m.reply_to_address ilike 'reply' || (n % 19) || '+x@r' || (n % 23) || '.%' and m.sender_address <> 'relay' || (n % 17) || '@hub.example.com' "
        "and m.subject <> 'view Report, nr ' || (n % 13)"]
    own = " union all ".join(f"select m.message_id, 'C' || n as rule_id, 'shape{i}' as target_category from mail m "
                             f"join (select c_custkey as n from customer where c_custkey % 4 = {i}) r on coalesce({x}, false)"
                             for i, x in enumerate(shapes))
    return f"{own} union all {seeds}"


@register("composite_rule_index", ops="B13 K26 B8 B9 C14", uses="mail", sql=_sql_rule_index())
def composite_rule_index(fx) -> DataFrame:
    """Every mail and composite rule row that holds for it, through the predicate index."""
    return matching_rules(fx.mail, composite_rule_rows(fx), keep=("target_category",))
