"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Everything runs as column expressions. Positions of matches come from the lengths of
the text between them, so a text is scanned a fixed number of times.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropunct.llm.common import Scratch

KINDS = ("email", "ip", "card", "phone")
ITERATIONS = 25
# A span that only the method proposes is added from this probability on.
ACCEPT = 0.9

# The kinds' patterns (fixed values), in forms that cannot backtrack far or recurse:
# a match starts where no longer one could, or right after the match before it.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Other ways to write them, which the method may add.
EMAIL_SPELT = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++"
    r"(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++"
)
IP_SIX = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
CARD_SHORT = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])"
PHONE_NATIONAL = r"(?<![0-9+)-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])"

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Gazetteers (fixed values).
TOP_DOMAINS = "com org net edu gov int info io co uk de fr es it nl eu ch at be us ca au jp cn in br mx ru".split()
CALLING_CODES = "1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 62 64 65 81 82 86 90 91".split()
HINTS = {
    "email": "mail|contact|write|reach|address|send",
    "ip": "host|server|addr|connect|login|client",
    "card": "card|visa|pay|credit|charge|account",
    "phone": "phone|call|tel|mobile|fax|ring|dial",
}
COUNTER_HINTS = "version|release|isbn|order|serial|token|section|chapter|sha|hash|build"

# Fields of a candidate; votes are 1 (personal data), -1 (not) and 0 (no opinion).
_CANDIDATE = (
    "array<struct<start:bigint,end:bigint,valid:boolean,votes:array<int>,features:array<string>>>"
)
N_VOTES = 5


@dataclass(frozen=True)
class Pattern:
    """A way to write a kind: its regular expression, where to try it, when it holds."""

    name: str
    kind: str
    regex: str
    tried: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    base: bool


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    backwards = F.reverse(_digits(match))
    digit = lambda i: F.substring(backwards, i, F.lit(1)).cast("int")
    doubled = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(backwards)),
        F.lit(0),
        lambda sum_, i: sum_ + F.when(i % 2 == 0, doubled(digit(i))).otherwise(digit(i)),
    )
    return total % 10 == 0


def _holds(sign: str) -> Callable[[Column], Column]:
    return lambda text: F.contains(text, F.lit(sign))


def _has_digit(text: Column) -> Column:
    return F.col("digit")


def _always(match: Column) -> Column:
    return F.lit(True)


def _octets(match: Column) -> Column:
    return match.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")


def _phone_length(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


PATTERNS = (
    Pattern("email", "email", EMAIL, _holds("@"), _always, True),
    Pattern("email_spelt", "email", EMAIL_SPELT, lambda t: t.rlike(r"(?i)[\[(]at[\])]"), _always, False),
    Pattern("ip", "ip", IP, _has_digit, _octets, True),
    Pattern("ip_six", "ip", IP_SIX, _has_digit, _always, False),
    Pattern("card", "card", CARD, _has_digit, luhn, True),
    Pattern("card_short", "card", CARD_SHORT, _has_digit, luhn, False),
    Pattern("phone", "phone", PHONE, _holds("+"), _phone_length, True),
    Pattern("phone_national", "phone", PHONE_NATIONAL, _has_digit, _always, False),
)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer(kind: str, match: Column) -> Column:
    if kind == "email":
        last = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1))
        return _vote(last.isin(TOP_DOMAINS), last.rlike("^[0-9]+$"))
    if kind == "phone":
        codes = "|".join(CALLING_CODES)
        return _vote(match.rlike(rf"^\+(?:{codes})(?![0-9]{{12}})|^\(?[2-9]"), match.rlike(r"^\+0|^\(?[01]"))
    if kind == "ip":
        return _vote(match.rlike("^(?:[1-9][0-9]?|1[0-9]{2}|2[0-2][0-9])[.]|:"), match.rlike("^(?:0|24|25)"))
    return _vote(match.rlike("^[3-6]"), match.rlike("^[01789]"))


def _char_class(char: Column) -> Column:
    return (
        F.when(F.coalesce(char, F.lit("")) == "", "none")
        .when(char.rlike(r"[\s]"), "space")
        .when(char.rlike("[A-Za-z]"), "letter")
        .when(char.rlike("[0-9]"), "digit")
        .when(char.rlike(r"[.,;:!?)\]]"), "stop")
        .otherwise("sign")
    )


def _candidate(pattern: Pattern, match: Column, left: Column, right: Column, start: Column) -> Column:
    """A match with the votes on it and the features the classifier sees."""
    valid = pattern.valid(match)
    before, after = F.right(left, F.lit(1)), F.substring(right, 1, 1)
    hint = F.lower(left)
    glued = before.rlike(r"[A-Za-z0-9=_/\"]") | after.rlike(r"[A-Za-z0-9=_/\"]")
    clean = before.rlike(r"^[\s(<\[:]?$") & after.rlike(r"^[\s.,;:!?)>\]#*$%&|]?$")
    digits = _digits(match)
    votes = F.array(
        _vote(valid if pattern.base else F.lit(False), ~valid),
        _gazetteer(pattern.kind, match),
        _vote(hint.rlike(HINTS[pattern.kind]), hint.rlike(COUNTER_HINTS)),
        _vote(clean, glued),
        _vote(F.lit(False), digits.rlike(r"^([0-9])\1+$|^0123456|^1234567")),
    )
    form = F.when(valid, pattern.name).otherwise("failed")
    features = F.array(
        form,
        _char_class(before),
        _char_class(after),
        F.least(F.floor(F.length(match) / 4), F.lit(8)).cast("string"),
        _gazetteer(pattern.kind, match).cast("string"),
        F.when(hint.rlike(COUNTER_HINTS), "against").when(hint.rlike(HINTS[pattern.kind]), "for").otherwise("none"),
    )
    return F.struct(
        start.cast("long").alias("start"),
        (start + F.length(match)).cast("long").alias("end"),
        valid.alias("valid"),
        votes.alias("votes"),
        features.alias("features"),
    )


def _located(pattern: Pattern) -> Column:
    """Candidates of a pattern, from its matches and the pieces of text between them."""
    found, pieces = F.col(f"found_{pattern.name}"), F.col(f"pieces_{pattern.name}")
    none = F.array().cast(_CANDIDATE)

    def step(state: Column, i: Column) -> Column:
        left, match = F.element_at(pieces, i), F.element_at(found, i)
        start = state["at"] + F.length(left)
        context = F.right(left, F.lit(40))
        right = F.element_at(pieces, i + 1)
        return F.struct(
            (start + F.length(match)).cast("long").alias("at"),
            F.array_append(state["out"], _candidate(pattern, match, context, right, start)).alias("out"),
        )

    begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    whole = F.aggregate(F.sequence(F.lit(1), F.size(found)), begin, step, lambda state: state["out"])
    return F.when(F.size(found) > 0, whole).otherwise(none)


def candidates(docs: DataFrame, carry: str = "doc_id") -> DataFrame:
    """``carry`` and an array of candidates for each pattern, from one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(carry, text.alias("text")).withColumn("digit", F.col("text").rlike("[0-9]"))
    nothing = F.array().cast("array<string>")
    found = [
        F.when(p.tried(F.col("text")), F.regexp_extract_all("text", F.lit(p.regex), F.lit(0)))
        .otherwise(nothing)
        .alias(f"found_{p.name}")
        for p in PATTERNS
    ]
    rows = rows.select(carry, "text", *found)
    pieces = [
        F.when(F.size(f"found_{p.name}") > 0, F.split("text", p.regex, -1)).alias(f"pieces_{p.name}")
        for p in PATTERNS
    ]
    rows = rows.select(carry, *[f"found_{p.name}" for p in PATTERNS], *pieces)
    return rows.select(carry, *[_located(p).alias(p.name) for p in PATTERNS])


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda c: F.struct(F.lit(kind).alias("kind"), c["votes"].alias("votes"), c["features"].alias("features"))


def _tallied(table: DataFrame) -> DataFrame:
    """How many candidates of a kind have the same votes and features."""
    parts = []
    for kind in KINDS:
        names = [p.name for p in PATTERNS if p.kind == kind]
        parts.append(F.transform(F.concat(*names), _of_kind(kind)))
    return (
        table.filter(" OR ".join(f"size({p.name}) > 0" for p in PATTERNS))
        .select(F.explode(F.concat(*parts)).alias("c"))
        .select("c.kind", F.col("c.votes").alias("votes"), F.col("c.features").alias("features"))
        .groupBy("kind", "votes", "features")
        .agg(F.count("*").alias("n"))
    )


def _likelihood(votes: Column, table: Column) -> Column:
    """Product of the labelers' probabilities for their votes; ``table`` has three each."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(N_VOTES - 1)),
        F.lit(1.0),
        lambda product, l: product
        * F.element_at(table, (3 * l + F.element_at(votes, l + 1) + 2).cast("int")),
    )


def _posterior(votes: Column, model: Column) -> Column:
    yes = model["prior"] * _likelihood(votes, model["yes"])
    no = (1 - model["prior"]) * _likelihood(votes, model["no"])
    return yes / (yes + no)


def reliabilities(tallies: DataFrame) -> DataFrame:
    """(kind, model): prior and each labeler's vote probabilities under either truth.

    Expectation-maximisation (Dawid and Skene, 1979), folded over the vote patterns
    of a kind, of which there are at most 3 to the power of the labelers. It starts
    from labelers that are right in three votes of four, which fixes the sides.
    """
    patterns = tallies.groupBy("kind", "votes").agg(F.sum("n").cast("double").alias("n"))
    by_kind = patterns.groupBy("kind").agg(
        F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("patterns")
    )
    start = F.struct(
        F.lit(0.5).alias("prior"),
        F.array(*[F.lit(v) for _ in range(N_VOTES) for v in (0.1, 0.3, 0.6)]).alias("yes"),
        F.array(*[F.lit(v) for _ in range(N_VOTES) for v in (0.6, 0.3, 0.1)]).alias("no"),
    )
    cells = F.array(*[F.struct(F.lit(l + 1).alias("l"), F.lit(v).alias("v")) for l in range(N_VOTES) for v in (-1, 0, 1)])

    def share(rated: Column, cell: Column, weight: Callable[[Column], Column]) -> Column:
        add = lambda c: F.aggregate(rated, F.lit(0.0), lambda s, p: s + F.when(c(p), weight(p)).otherwise(0.0))
        return (add(lambda p: F.element_at(p["votes"], cell["l"]) == cell["v"]) + 0.5) / (add(lambda p: F.lit(True)) + 1.5)

    def maximised(rated: Column) -> Column:
        yes = lambda p: p["n"] * p["r"]
        no = lambda p: p["n"] * (1 - p["r"])
        total = lambda w: F.aggregate(rated, F.lit(0.0), lambda s, p: s + w(p))
        return F.struct(
            ((total(yes) + 1) / (total(yes) + total(no) + 2)).alias("prior"),
            F.transform(cells, lambda c: share(rated, c, yes)).alias("yes"),
            F.transform(cells, lambda c: share(rated, c, no)).alias("no"),
        )

    def step(model: Column, _: Column) -> Column:
        rated = F.transform(
            "patterns",
            lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), _posterior(p["votes"], model).alias("r")),
        )
        # A list of one, so that the rated patterns are computed once.
        return F.element_at(F.transform(F.array(rated), maximised), 1)

    fold = F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), start, step)
    return by_kind.select("kind", fold.alias("model"))


def _classifier(tallies: DataFrame, models: DataFrame) -> tuple[dict[str, float], dict[tuple, float]]:
    """Naive Bayes on the features, trained on the posteriors of the votes.

    Returns the log odds of each kind and of each feature value: a few dozen numbers,
    as kinds, features and their values are fixed lists.
    """
    rated = tallies.join(F.broadcast(models), "kind").withColumn("r", _posterior(F.col("votes"), F.col("model")))
    sums = rated.groupBy("kind").agg(
        F.sum(F.col("n") * F.col("r")).alias("yes"), F.sum(F.col("n") * (1 - F.col("r"))).alias("no")
    )
    values = (
        rated.select("kind", "n", "r", F.posexplode("features").alias("place", "value"))
        .groupBy("kind", "place", "value")
        .agg(F.sum(F.col("n") * F.col("r")).alias("yes"), F.sum(F.col("n") * (1 - F.col("r"))).alias("no"))
        .join(F.broadcast(sums.select("kind", F.col("yes").alias("all_yes"), F.col("no").alias("all_no"))), "kind")
        .select("kind", "place", "value", F.log((F.col("yes") + 1) / (F.col("all_yes") + 8) * (F.col("all_no") + 8) / (F.col("no") + 1)))
    )
    prior = {r[0]: r[1] for r in sums.select("kind", F.log((F.col("yes") + 1) / (F.col("no") + 1))).collect()}
    return prior, {tuple(r)[:3]: r[3] for r in values.collect()}


def _accepted(kind: str, candidate: Column, prior: dict, values: dict) -> Column:
    """Probability by the classifier of at least ``ACCEPT``."""
    odds = F.lit(float(prior.get(kind, 0.0)))
    for place in range(6):
        own = {v: x for (k, p, v), x in values.items() if (k, p) == (kind, place)}
        if own:
            table = F.create_map(*[F.lit(x) for v in sorted(own) for x in (v, float(own[v]))])
            odds = odds + F.coalesce(F.element_at(table, F.element_at(candidate["features"], place + 1)), F.lit(0.0))
    return 1 / (1 + F.exp(-odds)) >= ACCEPT


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every whole text.

    Patterns propose candidates in one pass over the texts. Five labelers vote on each
    (format, gazetteer, words before it, characters around it, shape); EM estimates
    how reliable they are from how their votes agree, and a naive Bayes classifier on
    the span's features is trained on the resulting probabilities. Base patterns that
    hold always stay; other ways to write a kind are added where the classifier
    accepts them and no base span overlaps. Candidates that fail their check only
    serve as counterexamples. The counts and the digest are those of the base spans.

    Null and empty texts have no spans. Repeated rows are searched each; other columns
    are not read. Only tallies of candidates are shuffled, and what reaches the driver
    is bounded by the fixed lists of kinds and features.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.keep(candidates(docs), "candidates")
    return _decided(found, *_fitted(found, scratch)).select(
        "doc_id",
        *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("all").alias("spans"),
    )


def _fitted(found: DataFrame, scratch: Scratch) -> tuple[dict, dict]:
    tallies = scratch.keep(_tallied(found), "tallies")
    models = scratch.keep(reliabilities(tallies), "models")
    return _classifier(tallies, models)


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span found in ``text`` replaced by its kind in brackets.

    Overlapping spans become one, named after the first. ``n_chars``, where there is
    such a column, follows the new text. Rows without spans, null texts and all other
    columns stay as they are. The texts are read twice, to fit and to replace, and
    not shuffled.
    """
    prior, values = _fitted(candidates(docs), Scratch(docs.sparkSession, "mask"))
    rows = _decided(candidates(docs.select("text", F.struct("*").alias("_row")), "_row"), prior, values)
    named = lambda k: lambda s: F.struct(s["start"], s["end"], F.lit(f"[{k.upper()}]").alias("name"))
    spans = F.array_sort(F.concat(*[F.transform(f"all_{k}", named(k)) for k in KINDS]))
    text = F.col("_row.text")

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.array_append(F.array_append(state["out"], gap), span["name"]))
            .otherwise(state["out"])
            .alias("out"),
        )

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(
        "spans",
        begin,
        step,
        lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    replaced = rows.select("_row", spans.alias("spans")).select(
        "_row", F.when(F.size("spans") > 0, whole).otherwise(text).alias("_new")
    )
    changed = {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("_new").cast(kind)
        changed["n_chars"] = F.when(F.col("_new") == text, F.col("_row.n_chars")).otherwise(length)
    return replaced.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def _joined(prefix: str) -> Column:
    """kind:start:end of all spans, by kind and start."""
    written = lambda k: lambda s: F.concat(F.lit(f"{k}:"), s["start"], F.lit(":"), s["end"])
    parts = [F.transform(f"{prefix}_{k}", written(k)) for k in KINDS]
    return F.array_join(F.concat(*parts), ",")


def _decided(found: DataFrame, prior: dict, values: dict) -> DataFrame:
    """Adds base_<kind> and all_<kind>: sorted arrays of (start, end)."""
    place = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))
    rows = found.select(
        "*",
        *[F.transform(F.filter(p.name, lambda c: c["valid"]), place).alias(f"base_{p.kind}") for p in PATTERNS if p.base],
    )
    base = F.concat(*[f"base_{k}" for k in KINDS])
    free = lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    taken = lambda k: lambda c: c["valid"] & _accepted(k, c, prior, values) & free(c)
    added = {
        p.kind: F.transform(F.filter(p.name, taken(p.kind)), place) for p in PATTERNS if not p.base
    }
    return rows.select(
        "*", *[F.array_sort(F.concat(F.col(f"base_{k}"), added[k])).alias(f"all_{k}") for k in KINDS]
    )
