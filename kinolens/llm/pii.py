"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are what the fixed forms of e-mail addresses, IP addresses, card and
phone numbers find. The word in front of a seed, with its kind, is a lexical
pattern. Looser forms of the same kinds give candidates, whose own words in
front tie them to the same patterns. Over this graph of patterns and instances
two scores are computed in turns, until neither changes: a pattern is as sure as
the share of known identifiers (seeds, and candidates already found) among those
and the matches behind it that a fixed form has rejected, so that candidates
nobody knows yet do not count against it; an instance without a fixed form is as
sure as its trusted patterns together (noisy or). Candidates that end above the
bar in a place with a trusted pattern become spans; seeds always stay.

A candidate that a fixed form has matched but rejected (a card number with a
wrong check digit, an address part over 255) is not personal data and is left
alone.

Each text is read once, in one pass without a shuffle; what goes on are the few
matches with the characters in front of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import bound, given_id, keyed, stored

KINDS = ("email", "ip", "card", "phone")
#: Distinct seeds that a pattern needs, and what patterns and instances must score.
MIN_SEEDS = 5
TRUST = 0.9

# The fixed forms. Where a form may only begin at the head of a run, the
# look-behind says so, because later beginnings in it fail in the same way and
# need not be tried; \G lets a match follow another one directly. A repeated
# group is possessive where nothing follows it: otherwise the regular expression
# goes one call deeper per repeat, and a name of thousands of parts ends the JVM.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Digits with single separators between them, once those are turned into JOINT.
JOINT = "\u0001"
CARD = f"[0-9{JOINT}]{{2,}}"

# The looser forms.
LOOSE_EMAIL = r"(?<!\S)[^\s@]{1,64}(?:@|\(at\)|\[at\])[^\s@]{1,255}+"
LOOSE_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[.-][0-9]{4}(?![0-9.-])"
#: Card numbers with other separators or lengths; they must pass the Luhn check too.
LOOSE_CARD = r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,3}[0-9]{2,6}){2,4}(?![0-9])"
LOOSE_IP = r"(?<![\w:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![\w:])"

_NONE = "cast(array() as array<struct<s:int,e:int,v:string,left:string>>)"
#: White space other than the plain space, and as many spaces.
_SPACES = "\t\n\x0b\f\r"
#: Code points of the pieces from which a redacted text is put together.
CHUNK = 4096


def running(values: Column, join) -> Column:
    """Array of ``join`` over all elements up to each one, in n log n steps: what lies 1, 2, 4, ... places ahead joins in turn."""

    def step(done, k):
        return F.transform(done, lambda x, i: F.when(i >= k, join(x, F.get(done, i - k))).otherwise(x))

    far = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int") - 1), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.when(F.size(values) > 1, F.aggregate(far, values, step)).otherwise(values)


def matches(text: Column, pattern: str, possible: Column) -> Column:
    """Array of (s, e, v, left) of the leftmost matches that do not overlap, in code points.

    The text between matches comes from ``split`` with the same pattern, so
    running lengths give the places. ``left`` is the word in front, whatever
    its length, and empty if another match or nothing is there. ``possible`` is
    a cheap test without which no match can be.
    """

    def places(x):
        pairs = F.zip_with(F.slice(x["gaps"], 1, F.size(x["values"])), x["values"], lambda gap, v: F.struct(gap.alias("gap"), v.alias("v")))
        return bound(pairs, lambda p: bound(running(F.transform(p, lambda y: F.length(y["gap"]) + F.length(y["v"])), lambda a, b: a + b), lambda ends: F.zip_with(p, ends, hit)))

    def hit(y, e):
        left = F.substring_index(F.rtrim(F.translate(y["gap"], _SPACES, " " * len(_SPACES))), " ", -1)
        return F.struct((e - F.length(y["v"])).alias("s"), e.alias("e"), y["v"].alias("v"), left.alias("left"))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(possible, bound(found, places)).otherwise(F.expr(_NONE))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _ip(x: Column) -> Column:
    return x["v"].rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")


def _sixteen(x: Column) -> Column:
    return F.length(_digits(x["v"])).between(16, 19)


def _card(x: Column, least: int = 16) -> Column:
    """``least`` to 19 digits that pass the Luhn check; only short values are summed."""
    figures = F.transform(F.split(F.reverse(_digits(x["v"])), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    weighed = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    total = F.aggregate(weighed, F.lit(0), lambda a, d: a + d)
    return F.when(F.length(_digits(x["v"])).between(least, 19), total % 10 == 0).otherwise(F.lit(False))


def _phone(x: Column) -> Column:
    return F.length(_digits(x["v"])).between(8, 15)


#: Of one argument each: ``filter`` hands a second one the place of the match.
VALID = {"email": lambda x: F.lit(True), "ip": _ip, "card": lambda x: _card(x), "phone": _phone}


def hits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, email, ip, card, phone, refused, loose_email, loose_ip, loose_card, loose_phone): all matches of every text."""
    rows = keyed(docs, key, text)
    body = F.col("text")
    digit, dotted = body.rlike("[0-9]"), body.rlike(r"[0-9]\.[0-9]")
    joined = F.regexp_replace(F.translate(body, JOINT, "\u0002"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    long_number = body.rlike("[0-9][0-9\\x20-]{14,}[0-9]")
    raw = rows.select(
        "doc", "mark",
        matches(body, EMAIL, body.contains("@")).alias("email"),
        matches(body, IP, dotted).alias("ip"),
        matches(joined, CARD, long_number).alias("card"),
        matches(body, PHONE, body.contains("+")).alias("phone"),
        matches(body, LOOSE_EMAIL, body.contains("@") | body.contains("(at)") | body.contains("[at]")).alias("loose_email"),
        matches(body, LOOSE_IP, digit & body.contains(":")).alias("loose_ip"),
        matches(body, LOOSE_CARD, body.rlike("[0-9][0-9\\x20./_-]{11,}[0-9]")).alias("loose_card"),
        matches(body, LOOSE_PHONE, digit).alias("loose_phone"),
    )
    raw = stored(raw, "pii-matches")
    wrong = {"ip": lambda x: ~_ip(x), "card": lambda x: _sixteen(x) & ~_card(x), "phone": lambda x: ~_phone(x)}
    told = lambda k: lambda x: F.struct(F.lit(k).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"), x["left"].alias("left"))
    refused = F.concat(*[F.transform(F.filter(k, f), told(k)) for k, f in wrong.items()])
    kept = {k: F.filter(k, VALID[k]) for k in KINDS}
    return raw.select("doc", "mark", *[c.alias(k) for k, c in kept.items()], refused.alias("refused"), "loose_email", "loose_ip", F.filter("loose_card", lambda x: _card(x, 13)).alias("loose_card"), "loose_phone")


def _pattern(kind: str, left: Column) -> Column:
    """Kind and the word in front; null if there is none."""
    return F.when(left != "", F.concat(F.lit(f"{kind} "), F.lower(left)))


def _free(candidates: str) -> Column:
    """Those candidates that touch no match of a fixed form.

    Fixed matches stand at their begin and candidates at their end, in one
    order; a candidate is free if no match ahead of it reaches past its begin.
    """
    part = lambda at, fixed, reach, x: F.struct(at.alias("at"), F.lit(fixed).alias("fixed"), reach.alias("reach"), x.alias("x"))
    nothing = F.lit(None).cast("struct<s:int,e:int,v:string,left:string>")
    fixed = F.concat(*[F.transform(k, lambda t: part(t["s"], 1, t["e"], nothing)) for k in (*KINDS, "refused")])
    mine = F.transform(candidates, lambda c: part(c["e"], 0, F.lit(0), F.struct(c["s"].alias("s"), c["e"].alias("e"), c["v"].alias("v"), c["left"].alias("left"))))
    order = F.array_sort(F.concat(fixed, mine))
    reached = lambda o: bound(running(F.transform(o, lambda y: y["reach"]), F.greatest), lambda reach: F.zip_with(o, reach, lambda y, r: F.struct(y["fixed"].alias("fixed"), r.alias("reach"), y["x"].alias("x"))))
    free = F.filter(bound(order, reached), lambda y: (y["fixed"] == 0) & (y["reach"] <= y["x"]["s"]))
    return F.transform(free, lambda y: y["x"])


def occurrences(found: DataFrame) -> DataFrame:
    """(doc, mark, kind, s, e, value, pattern, seed): seeds, and candidates that touch no match of a fixed form."""
    parts = []
    for kind in KINDS:
        one = found.where(F.size(kind) > 0).select("doc", "mark", F.explode(kind).alias("x"))
        parts.append(one.select("doc", "mark", F.lit(kind).alias("kind"), "x.s", "x.e", F.lower("x.v").alias("value"), _pattern(kind, F.col("x.left")).alias("pattern"), F.lit(True).alias("seed")))
    for kind in KINDS:
        one = found.where(F.size(f"loose_{kind}") > 0).select("doc", "mark", F.explode(_free(f"loose_{kind}")).alias("x"))
        # brackets, quotes and stops around a candidate are not part of it
        core = F.regexp_replace(F.regexp_replace(F.col("x.v"), r"^[^\p{L}\p{N}(\[+]+", ""), r"[^\p{L}\p{N}]+$", "")
        lead = F.length("x.v") - F.length(F.regexp_replace(F.col("x.v"), r"^[^\p{L}\p{N}(\[+]+", ""))
        s = F.col("x.s") + lead
        one = one.select("doc", "mark", F.lit(kind).alias("kind"), s.alias("s"), (s + F.length(core)).alias("e"), F.lower(core).alias("value"), _pattern(kind, F.col("x.left")).alias("pattern"), F.lit(False).alias("seed"))
        parts.append(one.where("e > s"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def rejected(found: DataFrame) -> DataFrame:
    """(pattern, wrong): how many different matches behind a pattern a fixed form has rejected."""
    rows = found.where(F.size("refused") > 0).select(F.explode("refused").alias("x"))
    patterns = F.coalesce(*[F.when(F.col("x.kind") == k, _pattern(k, F.col("x.left"))) for k in KINDS])
    rows = rows.select(patterns.alias("pattern"), F.lower("x.v").alias("value")).where(F.col("pattern").isNotNull()).distinct()
    return rows.groupBy("pattern").agg(F.count(F.lit(1)).alias("wrong"))


def discovered(found: DataFrame, min_seeds: int = MIN_SEEDS, trust: float = TRUST) -> DataFrame:
    """(doc, mark, kind, s, e): spans that the patterns add to the fixed forms.

    Candidates are only ever added, and each raises its patterns, so the rounds
    end when one adds none.
    """
    every = stored(occurrences(found), "pii-occurrences")
    wrong = stored(rejected(found), "pii-rejected")
    edges = every.where(F.col("pattern").isNotNull()).groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed"))
    edges = stored(edges.withColumn("known", F.col("seed")), "pii-graph")
    before = -1
    while True:
        sure = edges.groupBy("pattern").agg(F.count_if("known").alias("right"), F.count_if("seed").alias("seeds")).where(F.col("seeds") >= min_seeds)
        sure = sure.join(wrong, "pattern", "left").withColumn("sure", F.col("right") / (F.col("right") + F.coalesce("wrong", F.lit(0))))
        sure = stored(sure.where(F.col("sure") >= trust).select("pattern", "sure"), "pii-patterns")
        # candidates only: seeds are known
        votes = edges.where(~F.col("seed")).join(sure, "pattern")
        doubt = F.sum(F.log(F.greatest(1 - F.col("sure"), F.lit(1e-6))))
        good = votes.groupBy("kind", "value").agg((1 - F.exp(doubt)).alias("vote")).where(F.col("vote") >= trust - 1e-9)
        good = stored(good.select("kind", "value", F.lit(True).alias("found")), "pii-votes")
        now = good.count()
        if now == before or not now:
            break
        before = now
        edges = edges.drop("known").join(good, ["kind", "value"], "left")
        edges = stored(edges.select("kind", "pattern", "value", "seed", (F.col("seed") | F.coalesce("found", F.lit(False))).alias("known")), "pii-graph")
    return every.where(~F.col("seed")).join(good, ["kind", "value"], "left_semi").join(sure, "pattern", "left_semi").select("doc", "mark", "kind", "s", "e").distinct()


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", min_seeds: int = MIN_SEEDS, trust: float = TRUST) -> DataFrame:
    """(doc, mark, base, added): arrays of (k, s, e) per row; k is the place of the kind in KINDS.

    Places are code points, ends exclusive. Empty and null texts have none.
    Rows that repeat id and text get the same spans, other columns are not
    read. A pattern needs ``min_seeds`` different seeds.
    """
    found = stored(hits(docs, key, text), "pii-hits")
    base = F.concat(*[_numbered(k) for k in KINDS])
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")) - 1
    added = discovered(found, min_seeds, trust).select("doc", "mark", F.struct(number.cast("int").alias("k"), "s", "e").alias("x"))
    added = stored(added.groupBy("doc", "mark").agg(F.array_sort(F.collect_set("x")).alias("added")), "pii-added")
    rows = found.select("doc", "mark", base.alias("base")).join(added, ["doc", "mark"], "left")
    return rows.withColumn("added", F.coalesce("added", F.expr("cast(array() as array<struct<k:int,s:int,e:int>>)")))


def _numbered(kind: str) -> Column:
    number = F.lit(KINDS.index(kind)).alias("k")
    return F.transform(kind, lambda x: F.struct(number, x["s"].alias("s"), x["e"].alias("e")))


def _count(kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.size(F.filter("base", lambda x: x["k"] == number)).cast("long").alias(f"n_{kind}")


def _written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans; counts are those of the fixed forms."""
    found = personal_data(docs)
    spans = F.array_sort(F.concat("base", "added"))
    return found.select(given_id().alias("doc_id"), *map(_count, KINDS), F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(spans).alias("spans"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in angle brackets, as ``<EMAIL>``.

    Spans that overlap are replaced together, by the kind that begins first.
    All other columns stay; ``n_chars``, if there is one, is counted anew where
    the text changed. A text is put together from chunks, so that its work grows
    with its length and its spans, not with their product.
    """
    found = personal_data(docs, key, text)
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    found = stored(found.where((F.size("base") > 0) | (F.size("added") > 0)).select("doc", "mark", spans.alias("spans")).dropDuplicates(["doc", "mark"]), "pii-spans")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = F.col(f"row.`{text}`")
    rows = rows.join(
        found,
        F.coalesce(F.col(f"row.`{key}`").cast("long"), F.lit(-(2**63))).eqNullSafe(F.col("doc")) & F.xxhash64(F.coalesce(body, F.lit(""))).eqNullSafe(F.col("mark")),
        "left",
    )
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def between(chunks, a, b):
        """Code points a to b: the few chunks that hold them are joined and cut."""
        head = F.floor(a / CHUNK).cast("int")
        held = F.array_join(F.slice(chunks, head + 1, F.floor(F.greatest(b - 1, a) / CHUNK).cast("int") - head + 1), "")
        return F.when(b > a, F.substring(held, a - head * CHUNK + 1, b - a)).otherwise(F.lit(""))

    def put_together(chunks, reach):
        def piece(x, i):
            at = F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0))
            return F.when(x["s"] < at, F.lit("")).otherwise(F.concat(between(chunks, at, x["s"]), F.get(kinds, x["k"])))

        tail = between(chunks, F.element_at(reach, -1), F.lit(CHUNK) * F.size(chunks))
        return F.array_join(F.concat(F.transform("spans", piece), F.array(tail)), "")

    chunks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    done = bound(chunks, lambda c: bound(running(F.transform("spans", lambda x: x["e"]), F.greatest), lambda reach: put_together(c, reach)))
    rows = rows.withColumn("changed", F.when(F.col("spans").isNotNull(), done))
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = F.coalesce("changed", value)
        elif c == "n_chars":
            value = F.when(F.col("changed").isNotNull(), F.length("changed").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return rows.select(*columns)
