"""Personal data by weak supervision, in DataFrame expressions only.

Candidates are base matches (fixed patterns with checks) and loose ones: written-out mail addresses, IP addresses with bracketed dots,
card numbers with dots or slashes between groups of four, and telephone numbers without a plus sign.
Four labelers vote on each candidate: the strict patterns, gazetteers (top-level domains, reserved networks, issuers, calling codes),
cue words before it, and the characters beside it. Expectation-maximisation over the counts of vote patterns (at most 3**4 rows)
estimates how reliable each labeler is and so each pattern's probability. With those as soft labels a naive Bayes span classifier is
trained on the spans' own features, what gazetteers and cue words say of them included; it alone decides: loose candidates that it
finds likelier personal than not are added. Base spans always stay.

Places are code points, end exclusive, found from the lengths of what lies between matches, summed up in runs of RUN matches and then
over the runs, so that a text of a hundred thousand spans takes seconds. Patterns have no nested backtracking, so long runs cost time
in proportion and no stack.

Rows: null text counts as empty; repeated rows and null ids are scored alike and kept; texts are searched whole. An empty table
gives no rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.store import written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns without nested backtracking; a run of name characters or digits is entered at its start only.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Of these a text must hold one for the pattern to be tried.
HINT = {("b", "email"): ("@",), ("b", "phone"): ("+",), ("l", "email"): ("at",), ("l", "ip"): ("[", "(")}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?[\[(](?:\.|dot)[\])]\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9./_-])[0-9]{4}(?:[./_][0-9]{4}){2,3}(?:[./_][0-9]{1,3})?(?![0-9./_-])",
    "phone": r"(?<![A-Za-z0-9.+/_=-])(?:\([0-9]{2,4}\)[\x20.-]?|00[0-9]{2,3}[\x20.-]|[0-9]{3}[.-])[0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9/_=-])",
}
#: Endings of mail domains: any of two letters (countries) and these.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "app", "dev", "cloud", "online", "site", "tech", "shop", "store", "blog", "email", "mobi", "jobs", "coop", "museum", "travel", "cat", "eus")
#: First digits of card numbers by their issuers.
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6)"
#: Networks that name no host of a person: this network, loopback, documentation, multicast and above.
NO_HOST = r"^(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-9])\D|^192\D+0\D+2\D|^198\D+51\D+100\D|^203\D+0\D+113\D"
#: Numbers set aside for fiction or made of one digit.
NO_PHONE = r"^0{3}|^(.)\1+$|555[-. ]?01\d\d$|^0?123456789"
RUN = 256
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|correo|courriel|adresse)\W*$",
    "ip": r"(?i)(?:\bip|host|server|address|client|login|from)\W*$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|carte|karte|tarjeta|account)(?:\s*(?:no|number|nummer|n°))?\W*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell|telefon|móvil)\W*$",
}
AGAINST = r"(?i)(?:version|isbn|order|invoice|item|page|section|build|rev|id|no|nr|#)\W*$"
LABELERS = ("strict", "gazetteer", "context", "beside")
FEATURES = ("gazetteer", "context", "size", "digits", "left", "right")



def _located(text: Column, pattern: str, matches: Column) -> Column:
    """The matches with their places and what is beside them."""
    between = F.split(text, pattern, -1)
    n = F.size(matches)
    rows = F.arrays_zip(F.slice(between, 1, n).alias("before"), matches.alias("s"), F.slice(between, 2, n).alias("after"))
    # outer lambdas bind what inner ones use, so that it is made once
    runs = F.transform(F.array(rows), lambda all_rows: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_rows) - 1) / RUN).cast("int")), lambda i: F.slice(all_rows, i * RUN + 1, F.lit(RUN))))[0]
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, end: int, s: string, left: string, right: string>>)").alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["before"])
        end = start + F.length(x["s"])
        span = F.struct(start.alias("start"), end.alias("end"), x["s"].alias("s"), F.substring(x["before"], -24, 24).alias("left"), F.substring(x["after"], 1, 1).alias("right"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def moved(run, by):
        return F.transform(run["out"], lambda x: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end"), x["s"].alias("s"), x["left"].alias("left"), x["right"].alias("right")))

    def placed(done):
        first = F.aggregate(done, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")), lambda acc, r: F.struct((acc["at"] + r["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(done, first, moved))

    return F.transform(F.array(F.transform(runs, lambda r: F.aggregate(r, empty, step))), placed)[0]


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = 2 * d
        return acc + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _passes(kind: str, s: Column) -> Column:
    digits = F.regexp_replace(s, "[^0-9]", "")
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(F.regexp_replace(s, "[^0-9]+", "."), r"\."), lambda p: (F.length(bare(p)) <= 3) & (F.coalesce(bare(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checked(kind: str):
    return lambda x: _passes(kind, x["s"])


def _described(spans: Column, kind: str, strict: bool) -> Column:
    """Spans with their votes (-1, 0, 1) and features."""

    def describe(x):
        s, digits = x["s"], F.regexp_replace(x["s"], "[^0-9]", "")
        if kind == "email":
            end = F.lower(F.regexp_extract(s, r"([A-Za-z0-9-]+)$", 1))
            known = end.rlike("^[a-z]{2}$") | end.isin(*TOP_LEVEL)
        elif kind == "ip":
            known = ~F.concat(s, F.lit(" ")).rlike(NO_HOST)
        elif kind == "card":
            known = digits.rlike(ISSUERS)
        else:
            known = ~digits.rlike(NO_PHONE)
        near = F.substring(x["left"], -1, 1)
        glued = near.rlike(r"[\p{L}\p{N}_=/\"'-]") | x["right"].rlike(r"[\p{L}\p{N}_=/\"'@-]")
        context = F.when(x["left"].rlike(CUES[kind]), 1).when(x["left"].rlike(AGAINST), -1).otherwise(0)
        share = F.length(digits) / F.length(s)
        side = lambda c: F.when(c == "", "none").when(c.rlike(r"^\s$"), "space").when(c.rlike(r"^[\p{L}\p{N}]$"), "word").otherwise("mark")
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(strict).alias("base"),
            F.lit(1 if strict else 0).alias("strict"), F.when(known, 1).otherwise(-1).alias("gazetteer"), context.alias("context"), F.when(glued, -1).otherwise(1).alias("beside"),
            F.when(F.length(s) < 10, "short").when(F.length(s) < 24, "middle").otherwise("long").alias("size"),
            F.when(share < 0.2, "few").when(share < 0.7, "some").otherwise("most").alias("digits"),
            side(near).alias("left"), side(x["right"]).alias("right"),
        )

    return F.transform(spans, describe)


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, base, loose): arrays of described spans; loose ones overlap no base span."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col), text.alias("_text"))
    names = []
    for label, patterns in (("b", BASE), ("l", LOOSE)):
        for kind, pattern in patterns.items():
            name = f"_{label}_{kind}"
            found = F.regexp_extract_all("_text", F.lit(pattern), 0)
            if hints := HINT.get((label, kind)):
                found = F.when(reduce(lambda x, y: x | y, (F.contains("_text", F.lit(h)) for h in hints)), found)
            df = df.withColumn(name, found)
            names.append((name, kind, pattern, label == "b"))
    none = F.expr("cast(null as array<struct<start: int, end: int, s: string, left: string, right: string>>)")
    for name, kind, pattern, _ in names:
        df = df.withColumn(name, F.when(F.size(name) > 0, _located(F.col("_text"), pattern, F.col(name))).otherwise(none))
    parts = {True: [], False: []}
    for name, kind, pattern, strict in names:
        kept = F.filter(F.col(name), _checked(kind))
        parts[strict].append(F.coalesce(_described(kept, kind, strict), F.array()))
    own = {f"_{kind}": spans for kind, spans in zip(BASE, parts[True])}
    df = df.select(id_col, F.concat(*parts[False]).alias("loose"), *[spans.alias(name) for name, spans in own.items()])
    df = df.select(id_col, "loose", *own, *[F.when(F.size("loose") > 0, _places(name)).alias(f"{name}_at") for name in own])
    free = F.filter("loose", lambda x: ~reduce(lambda found, name: found | _met(name, x), own, F.lit(False)))
    return df.select(id_col, F.concat(*own).alias("base"), free.alias("loose"))


STRETCH = 64  # code points


def _places(name: str) -> Column:
    """How many of the spans, which come in order, start before each stretch of the text, up to that of the last."""
    stretch = lambda x: F.floor(x["start"] / STRETCH).cast("int")
    before = lambda i: F.when(i > 0, stretch(F.get(F.col(name), i - 1))).otherwise(-1)
    return F.flatten(F.transform(name, lambda x, i: F.array_repeat(i, stretch(x) - before(i))))


def _met(name: str, x: Column) -> Column:
    """Whether the span meets one of those spans: looks at the few that start in its stretches, and the one before."""
    at = lambda stretch: F.coalesce(F.get(F.col(f"{name}_at"), stretch), F.size(name))
    first = F.greatest(at(F.floor(x["start"] / STRETCH).cast("int")) - 1, F.lit(0))
    last = at(F.floor((x["end"] - 1) / STRETCH).cast("int") + 1)
    return F.exists(F.slice(name, first + 1, last - first), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))


def reliabilities(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 50) -> tuple[float, list[dict[tuple[int, int], float]], dict[tuple[int, ...], float]]:
    """Expectation-maximisation over (votes, count): the share of personal spans, each labeler's P(vote | class), each pattern's probability.

    Labelers start better than chance, and pseudo-counts keep them so where there is little to see. Zero is abstention.
    """
    width = len(patterns[0][0]) if patterns else 0
    start = {(v, c): (0.6 if v == (1 if c else -1) else 0.25 if v == 0 else 0.15) for v in (-1, 0, 1) for c in (0, 1)}
    tables, prior = [dict(start) for _ in range(width)], 0.5
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes, _n in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(t[v, 1] / t[v, 0]) for t, v in zip(tables, votes))
            post[votes] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        total = sum(n for _, n in patterns)
        prior = min(0.99, max(0.01, (sum(n * post[v] for v, n in patterns) + 2) / (total + 4)))
        for k, t in enumerate(tables):
            for c in (0, 1):
                weight = {x: 4 * start[x, c] for x in (-1, 0, 1)}
                for votes, n in patterns:
                    weight[votes[k]] += n * (post[votes] if c else 1 - post[votes])
                s = sum(weight.values())
                for x in weight:
                    t[x, c] = weight[x] / s
    return prior, tables, post


def train(spans: DataFrame) -> dict:
    """The span classifier from (base, loose): for each kind, log odds of the prior and of each feature value."""
    flat = spans.select(F.explode(F.concat("base", "loose")).alias("x"))
    names = list(dict.fromkeys([*LABELERS, "kind", *FEATURES]))
    # 3**4 vote patterns times the few values of each feature, whatever the input
    rows = [(r.asDict(), r["count"]) for r in flat.groupBy(*[F.col(f"x.{c}").alias(c) for c in names]).count().collect()]
    votes: dict[tuple[int, ...], float] = {}
    for r, n in rows:
        key = tuple(r[c] for c in LABELERS)
        votes[key] = votes.get(key, 0) + n
    prior, tables, post = reliabilities(sorted(votes.items()))
    weight: dict[tuple, list[float]] = {}
    # pseudo-counts in the proportion of the classes: what is hardly seen hardly counts
    start = [2 * (1 - prior), 2 * prior]
    total = {kind: list(start) for kind in KINDS}
    for r, n in rows:
        p = post[tuple(r[c] for c in LABELERS)]
        for w in (total[r["kind"]], *(weight.setdefault((r["kind"], f, r[f]), list(start)) for f in FEATURES)):
            w[1] += n * p
            w[0] += n * (1 - p)
    odds = {(k, f, v): math.log((w[1] / total[k][1]) / (w[0] / total[k][0])) for (k, f, v), w in weight.items()}
    return {"priors": {k: math.log(t[1] / t[0]) for k, t in total.items()}, "features": odds, "reliabilities": dict(zip(LABELERS, tables)), "patterns": post}


def _log_odds(x: Column, model: dict) -> Column:
    def of_kind(kind: str) -> Column:
        out = F.lit(model["priors"][kind])
        for f in FEATURES:
            values = [(v, w) for (k, g, v), w in model["features"].items() if (k, g) == (kind, f)]
            out = out + reduce(lambda acc, p: F.when(x[f] == p[0], F.lit(p[1])).otherwise(acc), values, F.lit(0.0))
        return out

    return reduce(lambda acc, kind: F.when(x["kind"] == kind, of_kind(kind)).otherwise(acc), KINDS, F.lit(0.0))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id_col, base, added): arrays of (start, end, kind), sorted by start, kind as listed and end."""
    spans = written(candidates(docs, id_col, text_col), "spans")
    model = train(spans)
    place = F.array(*map(F.lit, KINDS))
    plain = lambda x: F.struct(x["start"].alias("start"), F.array_position(place, x["kind"]).cast("int").alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))
    cut = math.log(threshold / (1 - threshold))
    likely = F.filter("loose", lambda x: _log_odds(x, model) >= cut) if model["features"] else F.col("loose")
    return spans.select(id_col, F.array_sort(F.transform("base", plain)).alias("base"), F.array_sort(F.transform(likely, plain)).alias("added"))


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
