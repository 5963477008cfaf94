"""Personal data by weak supervision. DataFrame functions only.

Base spans are leftmost non-overlapping matches per kind (email, ip, card, phone) that pass a check of their own. Wider
patterns give further candidates: spelled-out mail addresses, national phone numbers, card-like numbers with a wrong
check digit, quoted secrets. Candidates that touch a base span are left out.

Five labelers vote (1, 0 or abstain) on every span: the strict pattern, a gazetteer of the kind, keywords in the text before
it, a check of its inner form, and the characters around it. Votes are grouped into patterns (at most kinds * 3 ** 5 rows,
whatever the size of the data); expectation-maximisation over them estimates how reliable each labeler is and how likely
each pattern is to be personal data. With these probabilities as soft labels a naive Bayes classifier is trained on features
of the span itself; its tables have one row per feature value, and it decides about the candidates. Base spans stay.

All steps but the grouped counts are row-wise expressions, so no text is shuffled. Positions are code points, ends exclusive.

Defined cases: null and empty texts have no spans (a null text stays null when redacted); without candidates nothing is
added; repeated rows count each; columns named like an added one are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchloom.llm.common import quoted, without

#: Kinds in output order with their patterns. Possessive forms and start conditions keep the matches of the plain
#: patterns but make long runs of matching characters linear.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[ -]?+[0-9])++", ""),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "+"),
}
WIDE = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z]{2,24}){1,3}", "at"),
    "card": (r"(?<![0-9])[0-9]{13,19}(?![0-9])", ""),
    "phone": (r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])", "-"),
    "secret": (r"(?<![A-Za-z_])[A-Za-z_]{3,32} ?[=:] ?\"[A-Za-z0-9_-]{20,128}\"", "\""),
}
KINDS = ("email", "ip", "card", "phone", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}
#: Fixed lists of the gazetteer and context labelers.
GAZETTEER = {
    "email": r"(?i)[.)\]] ?(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|ch|at|it|nl)$",
    "ip": r"^(?!0|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+?(?:1 ?)?\(?[2-9]|^\+[2-9]",
    "secret": r"(?i)^[a-z_]*(?:token|key|secret|passw|auth)",
}
CONTEXT = r"(?i)(?:mail|contact|kontakt|write|phone|tel|call|fax|mobil|card|karte|tarjeta|carte|visa|pay|server|host|addr|token|login|user)"
FORM = {
    "email": r"\.? ?[A-Za-z]{2,24}$",
    "ip": r"^[1-9][0-9]{0,2}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$",
    "phone": r"^\+?(?:[^0-9]*[0-9]){10,13}$",
    "secret": r"\"(?=[^\"]*[0-9])(?=[^\"]*[A-Za-z])[^\"]+\"$",
}
SHAPES = 512
LABELERS = 5
ACCEPT = 0.9
SPAN = "struct<s:int,e:int,m:string>"


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """Places and texts of all matches of a pattern: what lies between matches gives the places."""
    some = (F.contains(text, F.lit(hint)) if hint else text.rlike("[0-9]")) & text.rlike(pattern)
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(gaps, hits, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc, x):
        start = acc["p"] + x["g"]
        span = F.struct(start.alias("s"), (start + F.length(x["m"])).alias("e"), x["m"].alias("m"))
        here = F.when(x["m"].isNull(), acc["a"]).otherwise(F.array_append(acc["a"], span))
        return F.struct((start + F.coalesce(F.length(x["m"]), F.lit(0))).alias("p"), here.alias("a"))

    places = F.aggregate(pairs, F.struct(F.lit(0).alias("p"), none.alias("a")), step, lambda acc: acc["a"])
    return F.when(some, places).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check digit rule; digits is a text of 12 to 19 digits."""
    def weighed(k):
        d = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = F.when(k % 2 == 1, 2 * d).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _is_card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False)


PASSES = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"),
    "card": _is_card,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _described(text: Column, kind: str, base: bool, spans: Column) -> Column:
    """Spans with their votes and features, from the span and a few characters around it."""
    def one(x):
        m = x["m"]
        before = F.when(x["s"] > 0, F.substring(text, F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24)))).otherwise("")
        after = F.substring(text, x["e"] + 1, F.lit(1))
        glued = before.rlike(r"[\p{L}\p{N}]$") | after.rlike(r"^[\p{L}\p{N}]")
        form = _is_card(m) if kind == "card" else m.rlike(FORM[kind])
        strict = F.lit(1) if base else F.lit(0) if kind == "card" else F.lit(-1)
        votes = [
            strict, m.rlike(GAZETTEER[kind]).cast("int"), F.when(before.rlike(CONTEXT), 1).otherwise(-1),
            form.cast("int"), F.when(glued, 0).otherwise(1),
        ]
        features = [
            F.concat(F.lit("length "), F.least(F.length(m) / F.lit(4), F.lit(12)).cast("int").cast("string")),
            F.concat(F.lit("digits "), F.least(F.length(_digits(m)), F.lit(24)).cast("string")),
            # shapes share a fixed number of cells, so the classifier has a bounded number of features and leaves none out
            F.concat(F.lit("shape "), F.pmod(F.xxhash64(
                F.regexp_replace(F.regexp_replace(F.regexp_replace(m, r"[0-9]+", "9"), r"\p{L}+", "a"), r"\s+", "_")
            ), F.lit(SHAPES)).cast("string")),
            F.concat(F.lit("before "), F.when(before == "", "^").when(before.rlike(r"\p{L}$"), "a").when(before.rlike(r"\s$"), "_").otherwise(".")),
            F.concat(F.lit("after "), F.when(after == "", "$").when(after.rlike(r"\p{L}"), "a").when(after.rlike(r"\s"), "_").otherwise(".")),
            F.concat(F.lit("checked "), form.cast("string")),
        ]
        return F.struct(
            x["s"].alias("s"), F.lit(ORDER[kind]).alias("o"), x["e"].alias("e"), F.lit(kind).alias("kind"), F.lit(base).alias("base"),
            F.concat_ws(" ", *[v.cast("string") for v in votes]).alias("votes"), F.array(*features).alias("features"),
        )

    return F.transform(spans, one)


def passing(kind: str):
    return lambda x: PASSES[kind](x["m"])


def of_kind(kind: str):
    return lambda x: x["kind"] == kind


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add __base and __wide: described base spans and further candidates of each row, and __text (never null)."""
    out = without(docs, ["__text", "__base", "__wide"]).withColumn("__text", F.coalesce(quoted(text), F.lit("")))
    for k, (pattern, hint) in BASE.items():
        out = out.withColumn(f"__b_{k}", _matches(F.col("__text"), pattern, hint))
    for k, (pattern, hint) in WIDE.items():
        out = out.withColumn(f"__w_{k}", _matches(F.col("__text"), pattern, hint))
    base = [F.filter(f"__b_{k}", passing(k)) for k in BASE]
    out = out.withColumns({f"__b_{k}": b for k, b in zip(BASE, base, strict=True)})
    touched = F.concat(*[F.transform(f"__b_{k}", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in BASE])
    out = out.withColumn("__taken", touched)
    free = lambda x: ~F.exists("__taken", lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]))
    described = F.concat(*[_described(F.col("__text"), k, True, F.col(f"__b_{k}")) for k in BASE])
    wide = F.concat(*[_described(F.col("__text"), k, False, F.filter(f"__w_{k}", free)) for k in WIDE])
    out = out.withColumns({"__base": F.sort_array(described), "__wide": F.sort_array(wide)})
    return out.drop("__taken", *[f"__b_{k}" for k in BASE], *[f"__w_{k}" for k in WIDE])


@dataclass
class Model:
    """Log odds of each kind and of each feature value of a kind, and what EM found about the labelers."""

    prior: dict[str, float]
    odds: dict[str, float]
    reliability: dict[tuple[int, int, int], float]

    def probability(self, span: Column) -> Column:
        if not self.prior:
            return F.lit(0.0)
        table = F.create_map(*[F.lit(v) for pair in sorted(self.odds.items()) for v in pair])
        start = F.create_map(*[F.lit(v) for pair in sorted(self.prior.items()) for v in pair])
        own = F.transform(span["features"], lambda f: F.coalesce(F.try_element_at(table, F.concat_ws(" ", span["kind"], f)), F.lit(0.0)))
        total = F.aggregate(own, F.coalesce(F.try_element_at(start, span["kind"]), F.lit(-10.0)), lambda a, x: a + x)
        return 1 / (1 + F.exp(-total))


def expectation_maximisation(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50):
    """Soft labels of vote patterns (kind, votes, count), and P(vote | labeler, true or not)."""
    p = {}
    for kind, votes, _ in patterns:
        cast = [v for v in votes if v >= 0]
        p[kind, votes] = (sum(cast) + 0.5) / (len(cast) + 1)
    share: dict[str, float] = {}
    table: dict[tuple[int, int, int], float] = {}
    for _ in range(rounds):
        for kind in {k for k, _, _ in patterns}:
            own = [(p[k, v], n) for k, v, n in patterns if k == kind]
            share[kind] = (sum(a * n for a, n in own) + 1) / (sum(n for _, n in own) + 2)
        for i in range(LABELERS):
            for y in (0, 1):
                mass = {v: 1.0 for v in (-1, 0, 1)}
                mass[1 if y else 0] += 2.0  # a labeler is taken to be better than chance until the data say otherwise
                for k, votes, n in patterns:
                    mass[votes[i]] += n * (p[k, votes] if y else 1 - p[k, votes])
                for v, m in mass.items():
                    table[i, y, v] = m / sum(mass.values())
        for k, votes, _ in patterns:
            odds = math.log(share[k]) - math.log(1 - share[k])
            odds += sum(math.log(table[i, 1, v]) - math.log(table[i, 0, v]) for i, v in enumerate(votes))
            p[k, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return p, table


def fit(docs: DataFrame, text: str = "text", found: DataFrame | None = None) -> Model:
    """Estimate labelers and train the classifier on all spans and candidates of the documents."""
    found = find(docs, text) if found is None else found
    spans = found.select(F.explode(F.concat("__base", "__wide")).alias("x")).select("x.kind", "x.votes", "x.features")
    counted = spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()  # at most kinds * 3 ** LABELERS rows
    if not counted:
        return Model({}, {}, {})
    patterns = sorted((r.kind, tuple(map(int, r.votes.split())), r.n) for r in counted)
    soft, table = expectation_maximisation(patterns)
    weights = F.create_map(*[F.lit(v) for (k, votes), p in sorted(soft.items()) for v in (" ".join([k, *map(str, votes)]), p)])
    p = F.element_at(weights, F.concat_ws(" ", "kind", "votes"))
    features = (
        spans.select("kind", F.explode("features").alias("f"), p.alias("p")).groupBy("kind", "f")
        .agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    )
    rows = features.collect()  # at most kinds * (SHAPES + 50) rows
    total: dict[str, list[float]] = {}
    for (kind, votes, n) in patterns:
        own = total.setdefault(kind, [1.0, 1.0])
        own[0] += n * soft[kind, votes]
        own[1] += n * (1 - soft[kind, votes])
    prior = {k: math.log(a / b) for k, (a, b) in total.items()}
    odds = {f"{r.kind} {r.f}": math.log((r.yes + 1) / (total[r.kind][0] + 8)) - math.log((r.no + 1) / (total[r.kind][1] + 8)) for r in rows}
    return Model(prior, odds, table)


def spans_of(found: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """Add spans: base spans and accepted candidates as (s, o, e, kind), by start and kind."""
    plain = lambda x: F.struct(*[x[c].alias(c) for c in ("s", "o", "e", "kind")])
    added = F.filter("__wide", lambda x: model.probability(x) >= accept)
    both = F.sort_array(F.concat(F.transform("__base", plain), F.transform(added, plain)))
    return without(found, ["spans"]).withColumn("spans", both)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def redact(docs: DataFrame, model: Model, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Put <KIND> in the place of each span; overlapping spans become one. All columns are kept, whatever their names."""
    own = docs.select(*[quoted(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    at = f"__c{docs.columns.index(text)}"
    found = spans_of(find(own, at), model, accept)

    def step(acc, x):
        fresh = x["s"] >= acc["at"]
        gap = F.substring(F.col("__text"), acc["at"] + 1, x["s"] - acc["at"])
        out = F.when(fresh, F.concat(acc["out"], gap, F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    tail = lambda acc: F.concat(acc["out"], F.substring(F.col("__text"), acc["at"] + 1, F.length("__text")))
    clean = F.when(F.size("spans") == 0, quoted(at)).otherwise(F.aggregate("spans", start, step, tail))
    out = found.withColumn("__clean", clean)
    return out.select(*[F.col("__clean" if c == text else f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
