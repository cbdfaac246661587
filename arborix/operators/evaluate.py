"""Facts against rule graphs with three-valued logic (EVAL-*).

Two evaluators give the same verdicts: compiled() turns the rules into Columns over one wide row of facts per
case (no shuffle), relational() joins long facts to atoms and climbs the graph level by level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kleene import FALSE, TRUE, UNKNOWN, all_of, any_of, compare, name
from ..sources.package import settled


@dataclass(frozen=True)
class Atom:
    id: str
    key: str
    kind: str = "atomic_flag"
    operator: str = "IS_TRUE"
    value: float | None = None
    review: str = "ok"
    ready: bool | None = True
    minus: str = ""  # a second fact: the number is the first less this one (DEFN-3)


@dataclass(frozen=True)
class Composite:
    id: str
    operator: str
    children: tuple[str, ...]
    review: str = "ok"
    key: str = ""


@dataclass(frozen=True)
class Node:
    """A logic node: a composite with children, or a leaf with a condition key."""

    id: str
    operator: str = ""
    children: tuple[str, ...] = ()
    key: str = ""


@dataclass
class Rules:
    atoms: list[Atom]
    composites: list[Composite]
    nodes: list[Node]
    paths: list[tuple[str, str]]  # path id and its root node, in order
    links: dict[str, str] = field(default_factory=dict)  # condition key -> root atom or composite id

    def __post_init__(self):
        self.atom = {a.id: a for a in self.atoms}  # the last of a repeated id wins (S19)
        self.composite = {c.id: c for c in self.composites}
        self.node = {n.id: n for n in self.nodes}
        for n in self.nodes:
            for c in n.children:
                if c not in self.node:
                    raise KeyError(f"{n.id}: no node {c}")  # S22
        self.order = self._children_first()

    def _children_first(self) -> list[str]:
        """All ids that are evaluated, each after its children, however deep; a cycle is an error."""
        done, open_ids, out = set(), set(), []
        for top in [*self.atom, *self.composite, *self.node]:
            stack = [(top, iter(self.children(top)))] if top not in done else []
            open_ids.update(i for i, _ in stack)
            while stack:
                i, rest = stack[-1]
                c = next(rest, None)
                if c is None:
                    stack.pop()
                    open_ids.discard(i)
                    done.add(i)
                    out.append(i)
                elif c in open_ids:
                    raise ValueError(f"cycle at {c}")
                elif c not in done:
                    open_ids.add(c)
                    stack.append((c, iter(self.children(c))))
        return out

    def children(self, i: str) -> tuple[str, ...]:
        if i in self.node:
            n = self.node[i]
            if n.children:
                return n.children
            return (self.links[n.key],) if self.links.get(n.key) in self.atom or self.links.get(n.key) in self.composite else ()
        c = self.composite.get(i)
        return () if c is None or c.review == "needs_review" else tuple(c.children)

    def keys(self) -> dict[str, str]:
        """Condition keys that rules mention, and the kind of their facts."""
        return {a.minus: "atomic_numeric" for a in self.atom.values() if a.minus} | {a.key: a.kind for a in self.atom.values()}

    def height(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for i in self.order:
            out[i] = 1 + max((out[c] for c in self.children(i)), default=-1)
        return out


def atom_trit(a: Atom, flag: Column, number: Column, less: Column | None = None) -> Column:
    """EVAL-5: flag is null unless the fact is exactly true or false (S3), number null if the fact is missing (S2).

    Of an atom over two facts (DEFN-3) `less` is the second: either missing means FALSE, and so does a difference that is no number."""
    if a.minus:
        number = number - less
    if a.review == "needs_review" or a.ready is False:
        return F.lit(UNKNOWN)
    if a.kind == "atomic_flag":
        return F.lit(UNKNOWN) if a.operator != "IS_TRUE" else F.when(F.coalesce(flag, F.lit(False)), TRUE).otherwise(FALSE)
    if a.kind == "atomic_numeric":
        if a.value is None:
            return F.when(number.isNull(), FALSE).otherwise(UNKNOWN)
        return F.when(F.coalesce(compare(number, a.operator, F.lit(float(a.value))), F.lit(False)), TRUE).otherwise(FALSE)
    return F.lit(UNKNOWN)


def _combine(rules: Rules, i: str, trit) -> Column:
    """The verdict of a composite or node from those of its children (EVAL-7, EVAL-8)."""
    if i in rules.node and not rules.node[i].children:
        below = rules.children(i)
        return trit(below[0]) if below else F.lit(UNKNOWN)
    own = rules.node.get(i) or rules.composite[i]
    if isinstance(own, Composite) and own.review == "needs_review":
        return F.lit(UNKNOWN)
    below = [trit(c) if c in rules.atom or c in rules.composite or c in rules.node else F.lit(UNKNOWN) for c in own.children]
    return any_of(below) if own.operator == "OR" else all_of(below) if own.operator == "AND" else F.lit(UNKNOWN)


def compiled(rules: Rules, wide: DataFrame, case: str = "case_id") -> DataFrame:
    """wide has a row per case: `b_<key>` (boolean) and `n_<key>` (double) for the keys of rules.keys(). Adds `t_<id>` for every id."""
    null = {"b": F.lit(None).cast("boolean"), "n": F.lit(None).cast("double")}
    fact = lambda p, k: F.col(f"`{p}_{k}`") if f"{p}_{k}" in wide.columns else null[p]
    height = rules.height()
    out = wide.withColumns({f"t_{a.id}": atom_trit(a, fact("b", a.key), fact("n", a.key), fact("n", a.minus) if a.minus else None) for a in rules.atom.values()})
    for h in range(max(height.values(), default=0) + 1):
        level = [i for i in [*rules.composite, *rules.node] if height[i] == h]
        if level:
            out = out.withColumns({f"t_{i}": _combine(rules, i, lambda c: F.col(f"`t_{c}`")) for i in level})
    return out


def path_verdicts(rules: Rules, verdicts: DataFrame, case: str = "case_id") -> DataFrame:
    """(case, path_id, verdict, ord), a row for each path."""
    rows = F.array(*[F.struct(F.lit(p).alias("path_id"), F.col(f"`t_{r}`").alias("trit"), F.lit(k).alias("ord")) for k, (p, r) in enumerate(rules.paths)])
    return verdicts.select(case, F.explode(rows).alias("p")).select(case, "p.path_id", name(F.col("p.trit")).alias("verdict"), "p.ord")


def recommendation(rules: Rules, verdicts: DataFrame, case: str = "case_id") -> DataFrame:
    """EVAL-9: recommended if any path is TRUE (S20), with the TRUE paths in order."""
    paths = F.array(*[F.struct(F.lit(p).alias("path_id"), F.col(f"`t_{r}`").alias("trit")) for p, r in rules.paths])
    true = F.transform(F.filter(paths, lambda x: x["trit"] == TRUE), lambda x: x["path_id"])
    return verdicts.select(case, (F.size(true) > 0).alias("recommended"), true.alias("matched_paths"))


def matched_keys(rules: Rules, verdicts: DataFrame, case: str = "case_id") -> DataFrame:
    """EVAL-10: keys on chains that are TRUE all the way from a TRUE path, sorted and distinct; a logic composite adds none of its own (S21)."""
    chains: dict[str, list[Column]] = {}

    def walk(i: str, so_far: Column) -> None:
        now = so_far & (F.col(f"`t_{i}`") == TRUE)
        key = rules.atom[i].key if i in rules.atom else rules.composite[i].key if i in rules.composite else ""
        if key:
            chains.setdefault(key, []).append(now)
        for c in rules.children(i):
            if c in rules.atom or c in rules.composite or c in rules.node:
                walk(c, now)

    for _, root in rules.paths:
        walk(root, F.lit(True))
    hits = []
    for key in sorted(chains):
        some = chains[key][0]
        for c in chains[key][1:]:
            some = some | c
        hits.append(F.when(some, F.lit(key)))
    return verdicts.select(case, F.array_compact(F.array(*hits)).alias("matched_conditions"))


def occurrences(rules: Rules) -> list[tuple[int, str, str, str]]:
    """EVAL-11, S6: (ord, path_id, parent, id) for every time an id is evaluated, children before parents."""
    out: list[tuple[int, str, str, str]] = []

    def walk(path: str, parent: str, i: str) -> None:
        for c in rules.children(i):
            walk(path, i, c)
        out.append((len(out), path, parent, i))

    for path, root in rules.paths:
        walk(path, "", root)
    return out


def trace(rules: Rules, verdicts: DataFrame, case: str = "case_id") -> DataFrame:
    """(case, ord, path_id, parent, id, result): a row for every evaluated occurrence."""
    rows = F.array(*[F.struct(F.lit(o).alias("ord"), F.lit(p).alias("path_id"), F.lit(q).alias("parent"), F.lit(i).alias("id"), (F.col(f"`t_{i}`") if i in rules.atom or i in rules.composite or i in rules.node else F.lit(UNKNOWN)).alias("trit")) for o, p, q, i in occurrences(rules)])
    return verdicts.select(case, F.explode(rows).alias("x")).select(case, "x.ord", "x.path_id", "x.parent", "x.id", name(F.col("x.trit")).alias("result"))


def relational(rules: Rules, facts: DataFrame, cases: DataFrame) -> DataFrame:
    """(case_id, id, trit) of all ids from facts (case_id, condition_key, fact_kind, b, n); the rules' tables are small and broadcast.

    Each level of the rules is computed once, from the verdicts below it, and checkpointed. An atom over two facts (DEFN-3) is FALSE if
    either is missing, else UNKNOWN if either isn't a number that can be read."""
    spark = facts.sparkSession
    height = rules.height()
    atoms = spark.createDataFrame([(a.id, a.key, a.kind, a.operator, None if a.value is None else float(a.value), a.review == "needs_review" or a.ready is False, a.minus) for a in rules.atom.values()], "id string, condition_key string, kind string, op string, value double, gated boolean, minus string")
    asked_for = atoms.select("condition_key").unionByName(atoms.select(F.col("minus").alias("condition_key"))).distinct()
    known = facts.join(F.broadcast(asked_for), "condition_key", "left_semi")
    one = cases.select("case_id").distinct()
    asked = one.crossJoin(F.broadcast(atoms))  # a row for each atom of each case is the result itself
    both = asked.join(known.select("case_id", "condition_key", "fact_kind", "b", "n"), ["case_id", "condition_key"], "left")
    if any(a.minus for a in rules.atom.values()):
        second = known.select("case_id", F.col("condition_key").alias("minus"), F.col("fact_kind").alias("less_kind"), F.col("n").alias("less"))
        both = both.join(second, ["case_id", "minus"], "left")
    else:
        both = both.withColumns({"less_kind": F.lit(None).cast("string"), "less": F.lit(None).cast("double")})
    v, op, paired = F.col("value"), F.col("op"), F.col("minus") != ""
    n = F.when(paired, F.col("n") - F.col("less")).otherwise(F.col("n"))
    missing = lambda kind: F.col(kind).isNull() | (F.col(kind) == "null")
    test = F.when(op == ">", n > v).when(op == ">=", n >= v).when(op == "<", n < v).when(op == "<=", n <= v).when(op.isin("==", "="), n == v).otherwise(F.raise_error(F.concat(F.lit("unsupported operator: "), op)).cast("boolean"))
    flag = F.when(op != "IS_TRUE", UNKNOWN).when((F.col("fact_kind") == "bool") & F.col("b"), TRUE).otherwise(FALSE)
    number = F.when(missing("fact_kind") | (paired & missing("less_kind")), FALSE).when(n.isNull() | v.isNull(), UNKNOWN).when(test & ~F.isnan(n) & ~F.isnan(v), TRUE).otherwise(FALSE)
    trit = F.when(F.col("gated"), UNKNOWN).when(F.col("kind") == "atomic_flag", flag).when(F.col("kind") == "atomic_numeric", number).otherwise(UNKNOWN)
    done = settled(both.select("case_id", "id", trit.alias("trit")))
    there = {*rules.atom, *rules.composite, *rules.node}
    for h in range(max(height.values(), default=0) + 1):
        edges, constant = [], []
        for i in (i for i in [*rules.composite, *rules.node] if height[i] == h):
            own, below = rules.composite.get(i) or rules.node[i], rules.children(i)
            leaf = i in rules.node and not rules.node[i].children
            how = "AND" if leaf else own.operator
            if not below:
                gated = leaf or isinstance(own, Composite) and own.review == "needs_review"
                constant.append((i, UNKNOWN if gated else FALSE if how == "OR" else TRUE if how == "AND" else UNKNOWN))
            elif how not in ("OR", "AND") or not (held := [c for c in below if c in there]):
                constant.append((i, UNKNOWN))
            else:
                edges += [(i, how == "OR", len(held) < len(below), c) for c in dict.fromkeys(held)]
        level = []
        if edges:
            wide = F.broadcast(spark.createDataFrame(edges, "parent string, any boolean, lost boolean, id string"))
            best, worst, lost = F.max("trit"), F.min("trit"), F.bool_or("lost")  # a child that is nowhere is UNKNOWN
            trit = F.when(F.bool_or("any"), F.when(lost, F.greatest(best, F.lit(UNKNOWN))).otherwise(best)).otherwise(F.when(lost, F.least(worst, F.lit(UNKNOWN))).otherwise(worst))
            level.append(done.join(wide, "id").groupBy("case_id", F.col("parent").alias("id")).agg(trit.alias("trit")))
        if constant:
            level.append(one.crossJoin(F.broadcast(spark.createDataFrame(constant, "id string, trit int"))).select("case_id", "id", "trit"))
        if level:
            new = level[0].unionByName(level[1]) if len(level) > 1 else level[0]
            done = done.unionByName(settled(new))
    return done


def check_cases(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """EVAL-12: (case_id, passed, mismatches) from actual (case_id, recommended, matched_paths, matched_conditions) and expected
    (case_id, expected_recommended, expected_paths_exact, expected_paths_contains, expected_conditions_contains)."""
    both = expected.join(actual, "case_id", "left")
    missing = lambda want, have: F.array_except(F.coalesce(want, F.array().cast("array<string>")), F.coalesce(have, F.array().cast("array<string>")))
    problems = F.array_compact(F.array(
        F.when(~F.col("recommended").eqNullSafe(F.col("expected_recommended")), "recommended"),
        F.when(F.col("expected_paths_exact").isNotNull() & ~F.col("matched_paths").eqNullSafe(F.col("expected_paths_exact")), "paths"),
        F.when(F.size(missing(F.col("expected_paths_contains"), F.col("matched_paths"))) > 0, "paths missing"),
        F.when(F.size(missing(F.col("expected_conditions_contains"), F.col("matched_conditions"))) > 0, "conditions missing"),
    ))
    return both.select("case_id", (F.size(problems) == 0).alias("passed"), problems.alias("mismatches"))
