"""Personal data by patterns and by bootstrapped contexts, in DataFrame functions only.

Four kinds of base spans come from regular expressions and checks. Bootstrapping: base spans are seeds; the words to
their left are lexical patterns; identifier-like tokens share these patterns. In each turn, patterns that show enough
trusted instances become strong and the tokens they show become trusted instances, which in the next turn support
patterns that no seed ever stood under. Tokens under patterns that end up strong are spans of the seeds' kind. Edges
(pattern, instance) are counted before anything is shuffled by pattern or by instance.

A pattern is the last word of the LEFT signs before a span, so a context is bounded whatever the text. A token of more
than 64 signs is no identifier.

Spans are found without positions from the engine: the matches and the gaps between them partition the text, so their
running lengths are the places, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import words
from stallwise.sources import scratch

KINDS = ("email", "ip", "card", "phone")
# A match begins where a run of its first class begins or where the last match ended; anywhere else it would fail as
# well. Possessive repeats never change these matches and keep long runs linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# A token that may be an identifier: groups of digits, or six signs and more with a digit among them.
TOKEN = r"(?:\G|(?<![0-9]))[0-9]{2,}+(?:[\x20.-][0-9]{2,}+)++|(?:\G|(?<![A-Za-z0-9._%+@-]))(?=[A-Za-z._%+@-]*+[0-9])[A-Za-z0-9._%+@-]{6,64}+(?![A-Za-z0-9._%+@-])"
# What a pattern is made of: the last word of the 48 characters before a span, with the signs after it.
LEFT = 48
WORD_LEFT = r"([\p{L}\p{N}_-]+[^\p{L}\p{N}]{1,6})$"
TURNS = 3
# Weight of doubt in a pattern, the trusted instances of one kind that it must show, and the trust that it needs.
DOUBT = 3.0
SEEDS = 5
TRUST = 0.75
# Sums are taken in blocks of SUM_BLOCK, of which LEVELS are nested: enough for 16 million matches in one text.
SUM_BLOCK = 64
LEVELS = 4
SPAN = "struct<start:long,end:long,found:string,left:string>"


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value evaluated once, however often `use` names it inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(lengths: Column) -> Column:
    """Sum of all earlier items for each item: of those in its block, of the blocks before in its block of blocks, and so on.

    Each item adds up at most SUM_BLOCK numbers per level, so the work is linear in the items.
    """
    def add(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def blocks_of(items: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(items) - 1) / SUM_BLOCK)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: add(F.slice(items, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))))

    def before(levels: list[Column], i: Column) -> Column:
        parts = []
        for depth, level in enumerate(levels):
            at = F.floor(i / SUM_BLOCK**depth).cast("int")
            first = F.lit(0) if depth == LEVELS - 1 else F.floor(at / SUM_BLOCK).cast("int") * SUM_BLOCK
            parts.append(add(F.slice(level, first + 1, at - first)))
        return sum(parts[1:], parts[0])

    def nested(levels: list[Column]) -> Column:
        if len(levels) == LEVELS:
            return F.transform(levels[0], lambda _, i: before(levels, i))
        return _bound(blocks_of(levels[-1]), lambda level: nested([*levels, level]))

    return _bound(lengths, lambda items: nested([items]))


def _with_spans(df: DataFrame, name: str, text: str, pattern: str, hint: Column, fits=None) -> DataFrame:
    """Add `name`: array of spans of `pattern`; `hint` says whether the text can hold any."""
    found, gaps, at = f"{name}_found", f"{name}_gaps", f"{name}_at"
    df = df.withColumn(found, F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(gaps, F.when(F.size(found) > 0, F.split(text, pattern, -1)))
    df = df.withColumn(at, F.when(F.size(found) > 0, _running(F.zip_with(
        F.transform(found, F.char_length), F.transform(F.slice(gaps, F.lit(2), F.size(found)), F.char_length), lambda m, g: (m + g).cast("long")
    ))))
    spans = F.transform(found, lambda m, i: F.struct(
        (F.char_length(F.get(gaps, F.lit(0))) + F.get(at, i)).alias("start"),
        (F.char_length(F.get(gaps, F.lit(0))) + F.get(at, i) + F.char_length(m)).alias("end"),
        m.alias("found"), F.lower(F.right(F.get(gaps, i), F.lit(LEFT))).alias("left"),
    ))
    df = df.withColumn(name, spans.cast(f"array<{SPAN}>"))
    if fits is not None:
        df = df.withColumn(name, F.filter(name, lambda s: fits(s["found"])))
    return df.drop(found, gaps, at)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add an array of spans per kind: leftmost non-overlapping matches that pass their check."""
    docs = docs.withColumn("_text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    digit = F.col("_text").rlike("[0-9]")
    docs = _with_spans(docs, "email", "_text", EMAIL, F.col("_text").contains("@"))
    docs = _with_spans(docs, "ip", "_text", IP, digit, lambda m: m.rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$"))
    docs = _with_spans(docs, "card", "_text", CARD, digit, lambda m: F.char_length(_digits(m)).between(12, 19) & _luhn(_digits(m)))
    docs = _with_spans(docs, "phone", "_text", PHONE, F.col("_text").contains("+"), lambda m: F.char_length(_digits(m)).between(9, 15))
    docs = docs.withColumn("base", F.flatten(F.array(*[_of_kind(kind, i) for i, kind in enumerate(KINDS)])))
    return docs.drop(*KINDS)


def _of_kind(spans: str, number: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["found"].alias("found"), s["left"].alias("left")
    ))


def _pattern(left: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(left, WORD_LEFT, 1), "[0-9]+", "0")


def with_tokens(docs: DataFrame) -> DataFrame:
    """Add `tokens`: identifier-like spans that touch no base span."""
    docs = _with_spans(docs, "tokens", "_text", TOKEN, F.col("_text").rlike("[0-9]"))
    return docs.withColumn("tokens", F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))


def trusted(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(pattern, kind): strong patterns out of edges (pattern, instance, n) and seeds (instance, kind).

    Trust in a pattern is the trusted share of what it shows, with DOUBT unseen bad instances added; its support is the
    trust of all distinct instances of the kind that it shows. It is strong with a trust of TRUST and a support of
    SEEDS. Trust in a discovered instance is that some strong pattern around it is right; seeds are always trusted.
    """
    sure = seeds.withColumn("trust", F.lit(1.0))
    known = sure
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    for turn in range(TURNS):
        sums = edges.join(known, "instance").groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("trust")).alias("good"), F.sum("trust").alias("support")
        )
        rated = sums.join(totals, "pattern").withColumn("trust", F.col("good") / (F.col("total") + DOUBT))
        strong = rated.where((F.col("trust") >= TRUST) & (F.col("support") >= SEEDS) & (F.col("pattern") != ""))
        strong = scratch.cut(strong.select("pattern", "kind", "trust"))
        if turn < TURNS - 1:
            spread = edges.join(strong, "pattern").groupBy("instance", "kind").agg(
                (1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("trust")
            )
            known = scratch.cut(spread.join(seeds, ["instance", "kind"], "left_anti").unionByName(sure))
    return strong.groupBy("pattern").agg(F.max_by("kind", F.struct("trust", -F.col("kind"))).alias("kind"))


def find(docs: DataFrame) -> DataFrame:
    """Per distinct (doc_id, text): (doc_id, text_hash, base, more).

    `base`: array of (start, kind, end) in that order, kind by its place in KINDS; `more`: the same for tokens under
    trusted patterns. A NULL text is empty and has none; a NULL id is an id like others. Repeated rows of one id and
    text have one result.
    """
    rows = with_tokens(with_base(docs.select("doc_id", "text")))
    rows = rows.select("doc_id", F.xxhash64("_text").alias("text_hash"), "base", "tokens")
    rows = scratch.cut(rows)
    seeds = rows.select(F.explode("base").alias("s")).select(_pattern(F.col("s.left")).alias("pattern"), F.col("s.found").alias("instance"), F.col("s.kind").alias("kind"))
    tokens = rows.select("doc_id", "text_hash", F.explode("tokens").alias("t"))
    tokens = tokens.select("doc_id", "text_hash", _pattern(F.col("t.left")).alias("pattern"), F.col("t.found").alias("instance"), "t.start", "t.end")
    edges = seeds.select("pattern", "instance").union(tokens.select("pattern", "instance"))
    edges = scratch.cut(edges.groupBy("pattern", "instance").agg(F.count("*").cast("double").alias("n")))
    strong = trusted(edges, scratch.cut(seeds.select("instance", "kind").distinct()))
    new = tokens.join(strong, "pattern").groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("more")
    )
    plain = F.array_sort(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    base = rows.select("doc_id", "text_hash", plain.alias("base"))
    same = base["doc_id"].eqNullSafe(new["doc_id"]) & (base["text_hash"] == new["text_hash"])
    return base.join(new, same, "left").select(
        base["doc_id"], base["text_hash"], "base", F.coalesce("more", F.array().cast("array<struct<start:long,kind:int,end:long>>")).alias("more")
    )


def count(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span of personal data in `text` replaced by its kind in brackets; a NULL text stays NULL.

    Where spans of two kinds overlap, the stretch that both cover goes under the first one's kind.
    """
    own, hashed, spans = (words.free(docs, name) for name in ("_id", "_hash", "_spans"))
    found = find(docs).dropDuplicates(["doc_id", "text_hash"]).select(
        F.col("doc_id").alias(own), F.col("text_hash").alias(hashed), F.array_sort(F.array_union("base", "more")).alias(spans)
    ).where(F.size(spans) > 0)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(hashed))
    joined = docs.join(found, same, "left")
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        parts = F.concat(state["parts"], F.when(inside, F.array().cast("array<string>")).otherwise(
            F.array(F.substring(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")), F.get(kinds, s["kind"]))
        ))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        rest = F.substring(F.col("text"), (state["at"] + 1).cast("int"), F.lit(2**31 - 1))
        return F.concat(F.array_join(state["parts"], ""), rest)

    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.aggregate(spans, empty, step, finish))
    return joined.select(*[text.alias("text") if c == "text" else col for c, col in zip(docs.columns, columns)])
