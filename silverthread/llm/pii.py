"""Personal data: fixed patterns, and a bootstrap from the contexts of their finds.

What the fixed patterns find are seeds, and so are secrets of well-known forms. The words
and marks around a seed, its shape, and the two together are patterns; patterns and
identifiers form a graph, on which confidences are computed in rounds: a pattern is as
good as the identifiers it leads to, an identifier of no known kind as good as the
patterns that lead to it. Near misses of the fixed patterns, such as card numbers with a
wrong check digit, are known to be nothing. Patterns that lead to one kind nearly always
discover identifiers that the fixed patterns cannot see. Column expressions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import content_id, stage

KINDS = ("email", "ip", "card", "phone")
#: Kinds of the spans that the method adds.
ALL_KINDS = (*KINDS, "secret")
_SECRET, _UNKNOWN, _NOTHING = 4, -1, -2

#: The fixed patterns, written so that no text makes them backtrack or recurse: runs
#: are possessive and a match starts at the head of its run, or where the last ended.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind that counts.
_GATES = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9][\x20().0-9-]",
}
#: A token between white space that has a digit or an at sign.
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: What may surround an identifier in its token.
_EDGE = r"^[^A-Za-z0-9+@]+|[^A-Za-z0-9@]+$"

#: Secrets of well-known forms: long hexadecimal numbers, and keys and tokens that begin
#: as their issuers have them begin. Each has a letter and a digit.
SECRETS = (
    r"(?<![A-Za-z0-9_+/=-])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|A[KS]IA[0-9A-Z]{16}|gh[oprsu]_[A-Za-z0-9]{30,}+"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}+|sk[-_][A-Za-z0-9_-]{20,}+"
    r"|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+)(?![A-Za-z0-9])"
)
_SECRET_GATE = "[0-9a-f]{32}|[0-9A-F]{32}|A[KS]IA|gh[oprsu]_|xox[abprs]-|sk[-_]|eyJ"

#: Characters around an identifier in which whole words and marks are its context; a
#: word that reaches beyond them is none.
CONTEXT_CHARS = 48
#: A pattern is trusted if the lower end of the 95 % interval of its share of one kind
#: is at least this; that takes 16 different identifiers without an exception. One of
#: at least MIN_CANDIDATE speaks for its identifiers until the last round.
MIN_CONFIDENCE, MIN_CANDIDATE = 0.8, 0.25
ROUNDS = 4

#: Running sums are made in stretches of so many, then over the stretches.
_STRETCH = 512


def _running(values: Column) -> Column:
    return F.aggregate(
        values,
        F.array().cast("array<int>"),
        lambda sums, v: F.array_append(sums, F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0)) + v),
    )


def _ends(widths: Column) -> Column:
    """Running sums of a non-empty array of ints."""
    last = F.floor((F.size(widths) - 1) / _STRETCH).cast("int")
    sums = F.transform(
        F.sequence(F.lit(0), last),
        lambda j: _running(F.slice(widths, j * _STRETCH + 1, F.lit(_STRETCH))),
    )
    totals = F.transform(sums, lambda x: F.element_at(x, -1))
    return F.flatten(
        F.zip_with(
            sums,
            F.zip_with(_running(totals), totals, lambda head, own: head - own),
            lambda stretch, base: F.transform(stretch, lambda e: e + base),
        )
    )


_SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Spans of all matches from left to right. Positions follow from the lengths of
    the matches and of the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    widths = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m)
    )
    return F.zip_with(
        _ends(widths),
        found,
        lambda end, m: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes Luhn's check."""
    places = F.sequence(F.lit(1), F.length(digits))
    doubled = F.aggregate(
        F.transform(
            places,
            lambda i: (F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)),
        ),
        F.lit(0),
        lambda total, d: total + F.when(d > 9, d - 9).otherwise(d),
    )
    return doubled % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.coalesce(F.nullif(F.ltrim(p, F.lit("0")), F.lit("")), F.lit("0"))
        return F.forall(
            F.split(value, "[.]"),
            lambda p: F.when(F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(False),
        )
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _near_miss(kind: str, value: Column) -> Column:
    """Whether a match that failed its check shows what is not of its kind; a card
    number of another length may still be something else."""
    return F.length(_digits(value)).between(13, 19) if kind == "card" else F.lit(True)


def _judged(kind: str, number: int):
    value = lambda span: span["value"]
    return lambda span: F.struct(
        F.when(_valid(kind, value(span)), F.lit(number))
        .when(_near_miss(kind, value(span)), F.lit(_NOTHING))
        .otherwise(F.lit(_UNKNOWN)).alias("kind"),
        span["start"].alias("start"), span["end"].alias("end"), value(span).alias("value"),
    )


def _marks(text: Column) -> Column:
    """Finds of the fixed patterns in the order of :data:`KINDS`, near misses with the
    kind that stands for nothing, and secrets."""
    some = F.coalesce(text, F.lit(""))
    none = F.array().cast(_SPAN)
    parts = []
    for number, kind in enumerate(KINDS):
        gate = F.contains(some, F.lit("@")) if kind == "email" else some.rlike(_GATES[kind])
        found = F.when(gate & some.rlike(PATTERNS[kind]), _matches(some, PATTERNS[kind], number)).otherwise(none)
        parts.append(F.filter(F.transform(found, _judged(kind, number)), lambda s: s["kind"] != _UNKNOWN))
    found = F.when(some.rlike(_SECRET_GATE) & some.rlike(SECRETS), _matches(some, SECRETS, _SECRET)).otherwise(none)
    parts.append(F.filter(found, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")))
    return F.concat(*parts)


def base_spans(text: Column) -> Column:
    """All finds of the fixed patterns, by kind in the order of :data:`KINDS`, then by
    start: ``array<struct<kind, start, end, value>>`` with ends exclusive, in code
    points. A match that fails its check is dropped without another try."""
    return F.filter(_marks(text), lambda s: s["kind"].between(0, len(KINDS) - 1))


def _patterns(text: Column, span: Column) -> Column:
    """Patterns that lead to a span: the last word or mark before it, the last two, the
    first one after it, its shape, also without the lengths of its runs of digits, and
    its shape after the last word."""
    start, end = span["start"], span["end"]
    near = F.substring(
        text, F.greatest(start - CONTEXT_CHARS + 1, F.lit(1)), F.least(start, F.lit(CONTEXT_CHARS))
    )
    # A word that goes on before the window is left out, as is one that goes on after it.
    before = F.when(
        start > CONTEXT_CHARS, F.regexp_replace(near, r"^\p{L}+", "")
    ).otherwise(near)
    words = F.regexp_extract_all(F.lower(before), F.lit(r"\p{L}+[:=#]?|[:=#]"), F.lit(0))
    behind = F.substring(text, end + 1, F.lit(CONTEXT_CHARS))
    after = F.regexp_extract(F.lower(behind), r"^[^\p{L}:=#]{0,4}(\p{L}{1,40}|[:=#])(?!\p{L})", 1)
    shape = _shape(span["value"])
    last = lambda n: F.array_join(F.slice(words, -n, n), " ")
    found = F.array(
        F.when(F.size(words) >= 1, F.concat(F.lit("<"), last(1))),
        F.when(F.size(words) >= 2, F.concat(F.lit("<"), last(2))),
        F.when(after != "", F.concat(F.lit(">"), after)),
        F.concat(F.lit("~"), shape),
        F.concat(F.lit("="), F.regexp_replace(shape, "9[0-9]+", "9")),
        F.when(F.size(words) >= 1, F.concat(F.lit("<"), last(1), F.lit(" ~"), shape)),
    )
    return F.array_compact(found)


def _shape(value: Column) -> Column:
    """Runs of digits with their lengths, of letters without; long mixtures of digits and
    letters a to f by their length."""
    runs = F.regexp_extract_all(value, F.lit(r"[0-9]+|\p{L}+|[^0-9\p{L}]+"), F.lit(0))
    spelled = F.array_join(
        F.transform(
            runs,
            lambda r: F.when(r.rlike("^[0-9]"), F.concat(F.lit("9"), F.length(r).cast("string")))
            .when(r.rlike(r"^\p{L}"), F.lit("a")).otherwise(r),
        ),
        "",
    )
    hexadecimal = value.rlike("^[0-9A-Fa-f]{16,}$") & value.rlike("[A-Fa-f]")
    return F.when(hexadecimal, F.concat(F.lit("hex"), F.length(value).cast("string"))).otherwise(spelled)


def _tokens(text: Column) -> Column:
    """Identifier-like tokens: an at sign or at least six digits, without the marks
    around them."""
    some = F.coalesce(text, F.lit(""))
    found = F.when(
        some.rlike("[0-9][^\\x20\\x09-\\x0D]*[0-9]|@"), _matches(some, _TOKEN, -1)
    ).otherwise(F.array().cast(_SPAN))
    head = lambda v: F.length(v) - F.length(F.regexp_replace(v, "^[^A-Za-z0-9+@]+", ""))
    core = lambda v: F.regexp_replace(v, _EDGE, "")
    trimmed = F.transform(
        found,
        lambda s: F.struct(
            s["kind"],
            (s["start"] + head(s["value"])).alias("start"),
            (s["start"] + head(s["value"]) + F.length(core(s["value"]))).alias("end"),
            core(s["value"]).alias("value"),
        ),
    )
    return F.filter(
        trimmed,
        lambda s: (F.length(_digits(s["value"])) >= 6) | s["value"].rlike("[A-Za-z0-9]@[A-Za-z0-9]"),
    )


def _wilson(hits: Column, n: Column) -> Column:
    """Lower end of the 95 % interval of a share."""
    z2, p = 3.8416, hits / n
    middle = p + z2 / (2 * n)
    spread = F.sqrt(z2 * (p * (1 - p) / n + z2 / (4 * n * n)))
    return (middle - spread) / (1 + z2 / n)


def find_personal_data(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", hold_back: int = 0
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``base`` and ``added``, two arrays of spans.

    ``base`` has the finds of the fixed patterns (see :func:`base_spans`), ``added``
    secrets and the finds of the bootstrap, none of which overlaps a base span of its
    text; its kinds are numbers of :data:`ALL_KINDS`. With ``hold_back`` n, seeds whose
    value has a hash that n divides are not used as such, for trials (see
    :func:`held_back`): then ``added`` has what the bootstrap says of them. Null and empty texts have none. Repeated rows
    come out as often as given, null ids as nulls, and other columns are not used.

    The texts are read once; what goes on are the few spans and tokens. An identifier
    counts once per pattern, however often it is repeated, and patterns that lead to
    several kinds are dropped before anything is joined with them, so a word that
    stands before a third of all finds moves as one sum.
    """
    source = docs.select(
        F.col(doc_id).alias("doc_id"),
        content_id(F.col(doc_id), F.col(text)).alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    in_context = lambda s: F.struct(
        s["kind"], s["start"], s["end"], s["value"], _patterns(F.col("text"), s).alias("patterns")
    )
    found = stage(
        source.withColumn("marks", _marks(F.col("text")))
        .withColumn("tokens", _tokens(F.col("text")))
        .select(
            "doc_id",
            "row",
            F.transform("marks", in_context).alias("marks"),
            F.transform("tokens", in_context).alias("tokens"),
        ),
        "pii_found",
    )
    added = _discover(found, hold_back)
    base = F.filter("marks", lambda s: s["kind"].between(0, len(KINDS) - 1))
    spans = F.transform(base, lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"]))
    same = (F.col("row") == F.col("own_row")) & F.col("doc_id").eqNullSafe(F.col("own_id"))
    return found.join(added, same, "left").select(
        "doc_id",
        spans.cast(_SPAN).alias("base"),
        F.coalesce("added", F.array().cast(_SPAN)).alias("added"),
    )


def _held(value: Column, hold_back: int) -> Column:
    return F.pmod(F.xxhash64(F.lower(value)), F.lit(hold_back)) == 0 if hold_back else F.lit(False)


def _discover(found: DataFrame, hold_back: int = 0) -> DataFrame:
    """(own_id, own_row, added): secrets, and spans that trusted patterns lead to."""
    each = found.select(
        "doc_id", "row", F.explode(F.concat("marks", "tokens")).alias("s")
    ).select("doc_id", "row", "s.*")
    ordered = Window.partitionBy("doc_id", "row").orderBy("start", "end", "kind")
    is_mark = F.col("kind") != _UNKNOWN
    reached = F.max(F.when(is_mark, F.col("end"))).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(is_mark, F.col("start"))).over(ordered.rowsBetween(0, Window.unboundedFollowing))
    free = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (
        F.coalesce(ahead, F.col("end")) >= F.col("end")
    )
    seen = each.withColumn("free", free).where(is_mark | F.col("free"))
    if hold_back:
        held = (F.col("kind") >= 0) & _held(F.col("value"), hold_back)
        seen = seen.withColumn("kind", F.when(held, F.lit(_UNKNOWN)).otherwise(F.col("kind")))
    seen = stage(seen, "pii_seen")
    edges = stage(
        seen.select(F.explode("patterns").alias("pattern"), F.lower("value").alias("value"), "kind")
        .groupBy("pattern", "value")
        .agg(F.max("kind").alias("kind")),
        "pii_edges",
    )
    kinds = range(len(ALL_KINDS))
    unknown = edges.where(F.col("kind") == _UNKNOWN).select("pattern", "value")
    scores = None
    for number in range(ROUNDS):
        rows = edges if scores is None else edges.join(scores, "value", "left")
        said = [F.lit(0.0) if scores is None else F.coalesce(F.col(f"s{k}"), F.lit(0.0)) for k in kinds]
        own = [
            F.when(F.col("kind") == k, 1.0).when(F.col("kind") == _UNKNOWN, said[k]).otherwise(0.0)
            for k in kinds
        ]
        sums = rows.groupBy("pattern").agg(
            F.count("*").alias("n"), *[F.sum(x).alias(f"h{k}") for k, x in enumerate(own)]
        )
        least = MIN_CONFIDENCE if number == ROUNDS - 1 else MIN_CANDIDATE
        trusted = sums.select(
            "pattern", *[_wilson(F.col(f"h{k}"), F.col("n")).alias(f"c{k}") for k in kinds]
        ).where(F.greatest(*[F.col(f"c{k}") for k in kinds]) >= least)
        trusted = stage(trusted, "pii_patterns")
        # Each pattern that leads to an identifier adds to what speaks for it.
        doubt = lambda k: F.log(F.lit(1.0) - F.least(F.greatest(F.col(f"c{k}"), F.lit(0.0)), F.lit(0.99)))
        scores = unknown.join(trusted, "pattern").groupBy("value").agg(
            *[(F.lit(1.0) - F.exp(F.sum(doubt(k)))).alias(f"s{k}") for k in kinds]
        )
    best = F.array_max(F.array(*[F.struct(F.col(f"c{k}").alias("c"), F.lit(k).alias("k")) for k in kinds]))
    value, digits = F.col("value"), F.length(_digits(F.col("value")))
    looks = (
        F.when(F.col("k") == KINDS.index("email"), value.contains("@"))
        .when(F.col("k") == _SECRET, (F.length(value) >= 16) & (digits > 0) & value.rlike("[A-Za-z]"))
        .otherwise(digits >= 6)
    )
    discovered = (
        seen.where(F.col("kind") == _UNKNOWN)
        .select("doc_id", "row", "start", "end", "value", F.explode("patterns").alias("pattern"))
        .join(trusted.select("pattern", best.alias("best")), "pattern")
        .groupBy("doc_id", "row", "start", "end", "value")
        .agg(F.max("best").alias("best"))
        .withColumn("k", F.col("best.k"))
        .where(looks)
        .select("doc_id", "row", F.col("k").alias("kind"), "start", "end", "value")
    )
    secrets = seen.where(F.col("kind") == _SECRET).select("doc_id", "row", "kind", "start", "end", "value")
    return (
        discovered.unionByName(secrets)
        .groupBy(F.col("doc_id").alias("own_id"), F.col("row").alias("own_row"))
        .agg(F.sort_array(F.collect_set(F.struct("kind", "start", "end", "value"))).cast(_SPAN).alias("added"))
    )


def held_back(docs: DataFrame, hold_back: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """How the bootstrap does on seeds it is not told: per kind of :data:`ALL_KINDS`, the
    ``held`` spans, those ``found`` with their kind, and ``wrong`` ones, which were said
    to be of it and are another kind, or nothing. Distinct values, not spans, count."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marks = rows.select(F.explode(_marks(F.col("text"))).alias("s")).select(F.lower("s.value").alias("value"), "s.kind")
    truth = marks.groupBy("value").agg(F.max("kind").alias("kind"))
    said = (
        find_personal_data(rows, hold_back=hold_back)
        .select(F.explode("added").alias("s"))
        .groupBy(F.lower("s.value").alias("value")).agg(F.max("s.kind").alias("said"))
        .where(_held(F.col("value"), hold_back))
    )
    both = truth.where(_held(F.col("value"), hold_back)).join(said, "value", "full_outer")
    kinds = docs.sparkSession.createDataFrame(list(enumerate(ALL_KINDS)), "k int, name string")
    return kinds.join(both, (F.col("kind") == F.col("k")) | (F.col("said") == F.col("k")), "left").groupBy("name").agg(
        F.count_if(F.col("kind") == F.col("k")).alias("held"),
        F.count_if((F.col("kind") == F.col("k")) & (F.col("said") == F.col("k"))).alias("found"),
        F.count_if((F.col("said") == F.col("k")) & ~F.col("kind").eqNullSafe(F.col("k"))).alias("wrong"),
    )


def describe(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas in the given order."""
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count(spans: Column, kind: str) -> Column:
    number = ALL_KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
