"""Personal data in texts: exact base kinds, and further numbers by weak supervision.

Base kinds are found by their patterns and checks. Long numbers that are none of them are candidates: a
pattern labeler (how many digits), a gazetteer labeler (a cue word before the number) and a context labeler
(the signs around it) vote yes, no or nothing. Expectation-maximisation on the counts of vote patterns, of which
there are at most 27, estimates how reliable each labeler is; the resulting probabilities train a naive Bayes
classifier on the form and surroundings of the candidates, and it decides. DataFrame functions only.

Places are found without leaving SQL: ``split`` gives the text between the matches of a pattern and
``regexp_extract_all`` the matches; a running sum of their lengths is where each match stands.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidelog.session import written

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KIND = "number"

# The patterns state the same matches as the plain forms, in linear time: a match starts where a run of its
# first class starts (or, for email, where the last match ended), and what was consumed is not given back.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
NUMBER = r"(?<![0-9A-Za-z.+-])[0-9](?:[ .-]?[0-9]){6,}+(?![0-9A-Za-z])"

#: Words that announce a personal number, in the four languages of the texts.
CUES = "phone|tel|telephone|mobile|call|fax|contact|account|card|passport|ssn|id|telefon|konto|handy|ausweis|karte|tarjeta|cuenta|llamar|carte|compte|appeler"
AROUND = 24
EM_ROUNDS = 30


def matches(text: Column, pattern: str, needs: Column) -> Column:
    """``start, end, match`` of all matches of a pattern, in code points; none where ``needs`` is false."""
    kind = "array<struct<start: int, end: int, match: string>>"
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(between.alias("b"), found.alias("m"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["b"])
        size = F.coalesce(F.length(x["m"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), (start + size).alias("end"), x["m"].alias("match")))
        out = F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], one))
        return F.struct((start + size).alias("at"), out.alias("out"))

    return F.when(needs, F.aggregate(pairs, zero, step, lambda acc: acc["out"])).otherwise(F.array().cast(kind))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    back = F.reverse(_digits(match))

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(back, i, 1)) - 48
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add) % 10 == 0


def _small_parts(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(F.length(bare) <= 3, bare.cast("int") <= 255).otherwise(F.lit(False))

    return F.forall(F.split(match, r"\."), small)


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _candidates(text: Column, spans: Column, base: Column) -> Column:
    """Votes and features of the numbers that touch no base span."""
    free = F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def describe(s: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(s["start"] - AROUND, F.lit(0)) + 1, F.least(s["start"], F.lit(AROUND))))
        after = F.substring(text, s["end"] + 1, 2)
        n = F.length(_digits(s["match"]))
        cue = before.rlike(rf"(?:^|[^\p{{L}}])(?:{CUES})(?:[^\p{{L}}]|$)")
        marked = before.rlike(r"[:#(]\s*$")
        plain = before.rlike(r"[$€/=]\s*$") | after.rlike(r"^\s?[%€$/=]")
        vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
        size = F.when(n < 9, "7-8").when(n < 12, "9-11").when(n < 16, "12-15").otherwise("16+")
        breaks = F.least(F.length(s["match"]) - n, F.lit(4)).cast("string")
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.array(vote(n.between(9, 15), n > 19), vote(cue, F.lit(False)), vote(marked, plain)).alias("votes"),
            F.array(
                F.concat(F.lit("size="), size),
                F.concat(F.lit("breaks="), breaks),
                F.concat(F.lit("cue="), cue.cast("string")),
                F.concat(F.lit("before="), F.when(marked, "mark").when(plain, "plain").otherwise("other")),
            ).alias("features"),
        )

    return F.transform(free, describe)


def reliabilities(patterns: list[Row]) -> dict[tuple[int, ...], float]:
    """Probability of yes for each vote pattern (``votes``, ``n``), by expectation-maximisation.

    Votes are independent given the truth; each labeler has its own rates of yes, no and nothing
    under either truth. It starts from the majority of the votes.
    """
    rows = [(tuple(r.votes), r.n) for r in patterns]
    if not rows:
        return {}
    labelers, values = range(len(rows[0][0])), (-1, 0, 1)
    belief = {v: min(0.9, max(0.1, 0.5 + 0.2 * sum(v))) for v, _ in rows}
    total = sum(n for _, n in rows)
    for _ in range(EM_ROUNDS):
        yes = sum(belief[v] * n for v, n in rows)
        prior = (yes + 1) / (total + 2)
        rate = {}
        for j in labelers:
            for x in values:
                hit = [(belief[v] * n, (1 - belief[v]) * n) for v, n in rows if v[j] == x]
                rate[j, x] = ((sum(a for a, _ in hit) + 1) / (yes + 3), (sum(b for _, b in hit) + 1) / (total - yes + 3))
        for v, _ in rows:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rate[j, v[j]][0] / rate[j, v[j]][1]) for j in labelers)
            belief[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def _lookup(values: dict[str, float], key: Column) -> Column:
    if not values:
        return F.lit(0.0)
    table = F.create_map(*[x for k, v in sorted(values.items()) for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.element_at(table, key), F.lit(0.0))


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``, an array of (start, kind, end) by start and then kind, for every row.

    Starts and ends are code points of the whole text, ends exclusive; kinds are those of ``BASE_KINDS`` and
    ``number``. Base matches are leftmost and do not overlap within their kind; those that fail their check are
    dropped without another try. Null texts are empty and have no spans. Repeated rows and null ids are
    rows like others; other columns are not read. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    dotted = text.rlike(r"[0-9]\.[0-9]")
    numbers = text.rlike(r"[0-9](?:[ .-]?[0-9]){6}")
    found = rows.select(
        "doc_id",
        "text",
        matches(text, EMAIL, F.contains(text, F.lit("@"))).alias("email"),
        F.filter(matches(text, IP, dotted), lambda s: _small_parts(s["match"])).alias("ip"),
        F.filter(matches(text, CARD, numbers), lambda s: _luhn(s["match"])).alias("card"),
        F.filter(matches(text, PHONE, F.contains(text, F.lit("+"))), lambda s: F.length(_digits(s["match"])).between(10, 15)).alias("phone"),
        matches(text, NUMBER, numbers).alias("number"),
    )
    base = F.concat(*[_kind(F.col(k), k) for k in BASE_KINDS])
    based = found.select("doc_id", "text", base.alias("base"), "number")
    described = written(based.select("doc_id", "base", _candidates(text, F.col("number"), F.col("base")).alias("candidates")), "pii")

    each = described.select(F.explode("candidates").alias("c")).select("c.votes", "c.features")
    belief = reliabilities(each.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect())
    name = F.array_join(F.transform("votes", lambda v: v.cast("string")), ",")
    sure = _lookup({",".join(map(str, v)): p for v, p in belief.items()}, name)
    weighed = each.select(F.explode("features").alias("f"), sure.alias("p")).groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    counts = weighed.collect()  # the features have about twenty values
    yes, no = sum(r.yes for r in counts) / 4, sum(r.no for r in counts) / 4
    odds = {r.f: math.log((r.yes + 1) / (yes + 2)) - math.log((r.no + 1) / (no + 2)) for r in counts}
    prior = math.log((yes + 1) / (no + 1))

    def is_private(c: Column) -> Column:
        return reduce(lambda a, b: a + b, [_lookup(odds, F.element_at(c["features"], i)) for i in range(1, 5)]) + F.lit(prior) > 0

    added = _kind(F.filter("candidates", is_private), ADDED_KIND)
    order = {k: i for i, k in enumerate((*BASE_KINDS, ADDED_KIND))}
    number = lambda s: reduce(lambda w, k: w.when(s["kind"] == k, order[k]), BASE_KINDS[1:], F.when(s["kind"] == BASE_KINDS[0], 0)).otherwise(len(BASE_KINDS))
    keyed = F.transform(F.concat("base", added), lambda s: F.struct(s["start"].alias("start"), number(s).alias("no"), s["kind"].alias("kind"), s["end"].alias("end")))
    spans = F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return described.select("doc_id", spans.alias("spans"))
