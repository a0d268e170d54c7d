"""Personal data by candidate gradient boosting, in DataFrame functions only.

Per kind (email, ip, card, phone) a base pattern with its checks finds the sure
spans.  Wider generators propose further, overlapping candidates: obfuscated
addresses, other separators, numbers that fail a check.  Boosted trees score each
candidate by format and context features.  They are trained on what they decide:
the positives are sure spans rewritten into the wider forms in their place in the
text, the negatives the candidates that overlap no sure span of their kind and
rewritten spans with a broken check; sure spans as they are take no part.  A threshold per kind is calibrated on held-out
documents for ``precision`` (one rewritten span for every sure one); what scores
above it and overlaps no sure span is added.  The trees are written out as one expression, so scoring is part of
the scan: no shuffle, no Python.

The fit uses a bounded sample (``sample_docs`` documents, ``sample_candidates``
candidates); scanning covers every document and the whole text.

Defined cases: a null or empty text has no span; repeated rows have equal results;
positions are code points, the end exclusive; a sample without candidates of both
labels adds no span; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import sampled

KINDS = ("email", "ip", "card", "phone")
# The base patterns.  Written so that a scan is linear: a run is
# tried from its first character (or from the end of the match before), and is
# never given back; the matches are those of the plain forms.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
# The wider generators.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\[at\]|\(at\)|\{at\}| at ) ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}| dot ) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[.,:-][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ .-]{0,2}[0-9]){9,15}+(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ .()/-]{1,3}[0-9]{2,5}){2,4}(?![0-9])",
}
# What a text needs for a generator to be worth a scan.
NEEDS = {"email": r"@|[\[({](?:at|dot)[\])}]| dot | at  ?[A-Za-z0-9-]++ ?\. ?[A-Za-z0-9-]", "ip": r"[0-9][.,:-][0-9]", "card": r"[0-9]{4}", "phone": r"[0-9]{2}"}
CUES = {"email": r"(?i)(e-?mail|contact|write|address|send)", "ip": r"(?i)(\bip\b|host|server|address|ping)",
        "card": r"(?i)(card|visa|master|account|credit|payment)", "phone": r"(?i)(phone|tel|call|mobile|fax|dial|contact)"}
FEATURES = ("kind", "digits", "letters", "length", "spaces", "dashes", "dots", "others", "plus", "at", "luhn", "octets",
            "groups", "cue", "letter_before", "letter_after")
_SPAN = "struct<s:int,e:int,m:string>"
BLOCK = 256         # matches whose places are summed at a time
CHUNK = 2048        # characters of a piece of a text with many spans
MANY = 16           # spans of a text from which on places are looked up


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _places(both: Column, at: Column) -> Column:
    """``[{s, e, m}]`` of matches ``{m, gap}``, the first gap starting at ``at``."""
    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.char_length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))
    start = F.struct(at.alias("at"), F.expr(f"cast(array() AS array<{_SPAN}>)").alias("out"))
    return F.aggregate(both, start, step, lambda acc: acc["out"])


def _in_blocks(both: Column) -> Column:
    """:func:`_places` block by block: a growing array costs its length at each step."""
    def block(i: Column) -> Column:
        return F.slice(both, i * BLOCK + 1, F.lit(BLOCK))

    def begin(acc: Column, length: Column) -> Column:
        return F.struct((acc["at"] + length).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    numbers = F.sequence(F.lit(0), F.floor((F.size(both) - 1) / BLOCK).cast("int"))
    lengths = F.transform(numbers, lambda i: F.aggregate(block(i), F.lit(0), lambda n, x: n + x["gap"] + F.char_length(x["m"])))
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<int>)").alias("out"))
    return F.flatten(F.transform(F.aggregate(lengths, zero, begin, lambda acc: acc["out"]), lambda at, i: _places(block(i), at)))


def _matches(text: Column, pattern: str) -> Column:
    """``[{s, e, m}]``: places of all matches.  The pieces between matches, from
    ``split``, give the places that ``regexp_extract_all`` leaves out."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = F.zip_with(found, F.slice(pieces, F.lit(1), F.size(found)), lambda m, gap: F.struct(m.alias("m"), F.char_length(gap).alias("gap")))
    return _bound(both, lambda v: F.when(F.size(v) <= BLOCK, _places(v, F.lit(0))).otherwise(_in_blocks(v)))


def _around(text: Column, spans: Column, back: int, ahead: int) -> Column:
    """The spans with up to ``back`` characters ``before`` and ``ahead`` ``after`` each.
    A place in a text is found by a walk from its start, so a text with many spans is
    cut into chunks first."""
    def part(chunks: Column, start: Column, length: Column) -> Column:
        c = F.floor(start / CHUNK).cast("int")
        near = F.concat(F.coalesce(F.get(chunks, c), F.lit("")), F.coalesce(F.get(chunks, c + 1), F.lit("")))
        return F.when(F.size(chunks) > 0, near.substr(start - c * CHUNK + 1, length)).otherwise(text.substr(start + 1, length))

    def of(v: Column) -> Column:
        chunks = F.when(F.size(v) > MANY, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).otherwise(F.expr("cast(array() AS array<string>)"))
        return _bound(chunks, lambda ch: F.transform(v, lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), part(ch, F.greatest(x["s"] - back, F.lit(0)), F.least(x["s"], F.lit(back))).alias("before"),
            part(ch, x["e"], F.lit(ahead)).alias("after"))))
    return _bound(spans, of)


def _overlaps(spans: Column, x: Column) -> Column:
    """Whether one of ``spans``, in order and apart from one another, overlaps ``x``: of
    many, the last that begins before the end of ``x`` is found by halving."""
    def halve(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        before = F.coalesce(F.get(spans, mid)["s"] < x["e"], F.lit(False))
        return (F.when((acc["lo"] < acc["hi"]) & before, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi")))
                .when(acc["lo"] < acc["hi"], F.struct(acc["lo"].alias("lo"), mid.alias("hi"))).otherwise(acc))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1))).cast("int"))
    begun = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halve, lambda acc: acc["lo"])
    few = F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    return F.when(F.size(spans) <= MANY, few).otherwise(F.coalesce(F.get(spans, begun - 1)["e"] > x["s"], F.lit(False)))


def _found(text: Column, pattern: str, needs: Column) -> Column:
    return F.when(needs, _matches(text, pattern)).otherwise(F.expr(f"cast(array() AS array<{_SPAN}>)"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = _digits(m)

    def add(acc: Column, i: Column) -> Column:
        x = F.try_to_number(d.substr(F.length(d) - i + 1, F.lit(1)), F.lit("9")).cast("int")
        twice = x * 2 - F.when(x > 4, 9).otherwise(0)
        return acc + F.coalesce(F.when(i % 2 == 0, twice).otherwise(x), F.lit(0))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), add) % 10 == 0


def _octets(m: Column) -> Column:
    """Parts of four numbers that are at most 255."""
    parts = F.transform(F.split(m, "[^0-9]+"), lambda p: F.regexp_replace(p, "^0+(?!$)", ""))
    return F.size(F.filter(parts, lambda p: (F.length(p) > 0) & (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255")))


def _checked(kind: str, spans: Column) -> Column:
    def ok(x: Column) -> Column:
        m = x["m"]
        n = F.length(_digits(m))
        return {"email": F.lit(True), "ip": _octets(m) == 4, "card": n.between(14, 19) & _luhn(m), "phone": n.between(10, 15)}[kind]
    return F.filter(spans, ok) if kind != "email" else spans


def _count(m: Column, pattern: str) -> Column:
    return (F.length(m) - F.length(F.regexp_replace(m, pattern, ""))).cast("double")


def _features(kind: str, x: Column) -> list[Column]:
    """Features of a span with 24 characters before and one after it."""
    m, before = x["m"], x["before"]
    digits = F.length(_digits(m)).cast("double")
    values = {
        "kind": F.lit(float(KINDS.index(kind))), "digits": digits, "letters": _count(m, "[A-Za-z]"), "length": F.length(m).cast("double"),
        "spaces": _count(m, " "), "dashes": _count(m, "-"), "dots": _count(m, r"\."), "others": _count(m, r"[^A-Za-z0-9 .@+-]"),
        "plus": m.startswith("+").cast("double"), "at": _count(m, "@"), "luhn": F.when(digits >= 12, _luhn(m).cast("double")).otherwise(0.0),
        "octets": _octets(m).cast("double"), "groups": F.size(F.split(m, "[^0-9]+")).cast("double"),
        "cue": before.rlike(CUES[kind]).cast("double"), "letter_before": before.rlike(r"\p{L}$").cast("double"),
        "letter_after": x["after"].rlike(r"\p{L}").cast("double"),
    }
    return [values[f].alias(f) for f in FEATURES]


def _rewritten(kind: str, m: Column, draw: Column) -> Column:
    """A sure span in one of four forms that only the wider generator proposes.
    Names of addresses lose digits and length by turns, so that the form decides."""
    if kind == "email":
        local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
        for name in (0, 1):
            bare = F.regexp_replace((local, domain)[name], "[0-9]+", "")
            bare = F.when((F.floor(draw / 4) % 2 == 1) & bare.rlike(r"^[A-Za-z-][A-Za-z-]" if name else "^[A-Za-z]"), bare).otherwise((local, domain)[name])
            local, domain = (bare, domain) if name == 0 else (local, bare)
        local = F.when(F.floor(draw / 8) % 2 == 1, local.substr(F.lit(1), (3 + F.floor(draw / 16) % 8).cast("int"))).otherwise(local)
        domain = F.when(F.floor(draw / 128) % 2 == 1, F.regexp_replace(domain, "^([A-Za-z0-9-]{4,7})[A-Za-z0-9-]*", "$1")).otherwise(domain)
        ways = [("[at]", "[dot]"), (" (at) ", "."), (" at ", " dot "), ("{at}", "{dot}")]
        forms = [F.concat(local, F.lit(at), F.regexp_replace(domain, r"\.", dot)) for at, dot in ways]
    elif kind == "ip":
        forms = [F.regexp_replace(m, r"\.", by) for by in (",", "-", ":", "-")]
    elif kind == "card":
        forms = [F.regexp_replace(_digits(m), "(?<=^(?:[0-9]{4}){1,4})(?=[0-9])", by) for by in (".", "  ", "--", ". ")]
    else:
        plain, three = m.substr(F.lit(2), F.length(m)), "(?<=^(?:[0-9]{3}){1,4})(?=[0-9])"
        forms = [F.concat(F.lit("00"), plain), plain, F.regexp_replace(_digits(m), three, "."), F.regexp_replace(_digits(m), three, " ")]
    return F.get(F.array(*forms), (draw % 4).cast("int"))


def _broken(kind: str, m: Column, draw: Column) -> Column:
    """The same with its check broken; null for addresses, which have none."""
    d = _digits(m)
    if kind == "ip":
        return _rewritten(kind, F.concat(F.lit("999."), F.substring_index(m, ".", -3)), draw)
    if kind == "card":
        return _rewritten(kind, F.concat(d.substr(F.lit(1), F.length(d) - 1), ((F.right(d, F.lit(1)).cast("int") + 1) % 10).cast("string")), draw)
    if kind == "phone":     # as long as a date
        return F.concat_ws("-", d.substr(1, 4), d.substr(5, 2), d.substr(7, 2))
    return F.lit(None).cast("string")


def _planted(spans: DataFrame) -> DataFrame:
    """``id``, ``label`` and features of the candidates that cover a rewritten sure
    span (label 1) or meet one whose check is broken (label 0)."""
    out = None
    for kind in KINDS:
        x = F.col("x")
        rows = spans.select("id", F.explode(_around(F.col("text"), F.col(kind), 30, 30)).alias("x"))
        draw = F.pmod(F.xxhash64("id", x["s"]), F.lit(256))
        versions = F.array(*[F.struct(F.lit(label).alias("label"), how(kind, x["m"], draw).alias("m")) for label, how in ((1.0, _rewritten), (0.0, _broken))])
        rows = rows.select("id", x["before"].alias("before"), F.explode(versions).alias("v"), x["after"].alias("after")).where("v.m IS NOT NULL")
        rows = rows.select("id", "v.label", F.concat("before", "v.m", "after").alias("text"), F.char_length("before").alias("s"),
                           (F.char_length("before") + F.char_length("v.m")).alias("e"))
        wide = _around(F.col("text"), _matches(F.col("text"), WIDE[kind]), 24, 1)
        rows = rows.withColumn("x", F.explode(wide)).where((x["s"] < F.col("e")) & (F.col("s") < x["e"]))
        rows = rows.where((F.col("label") == 0) | ((x["s"] <= F.col("s")) & (F.col("e") <= x["e"]))).select("id", "label", *_features(kind, x))
        out = rows if out is None else out.union(rows)
    return out


def _with_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text``, the checked base spans of each kind and the candidates."""
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    digits = F.col("has_digit")
    out = out.withColumn("has_digit", text.rlike("[0-9]"))
    for kind, needs in (("email", F.contains(text, F.lit("@"))), ("ip", digits), ("card", digits), ("phone", F.contains(text, F.lit("+")))):
        out = out.withColumn(f"raw_{kind}", _found(text, BASE[kind], needs))
    out = out.select("id", "text", "has_digit", *[_checked(k, F.col(f"raw_{k}")).alias(k) for k in KINDS])
    for kind in KINDS:
        needs = text.rlike(NEEDS[kind]) if kind == "email" else digits & text.rlike(NEEDS[kind])
        out = out.withColumn(f"wide_{kind}", _found(text, WIDE[kind], needs))

    def candidate(kind: str) -> Column:
        wide = _around(text, F.col(f"wide_{kind}"), 24, 1)
        return _bound(F.col(kind), lambda sure: F.transform(wide, lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), _overlaps(sure, x).alias("sure"), *_features(kind, x))))
    return out.select("id", "text", *KINDS, F.concat(*[candidate(k) for k in KINDS]).alias("candidates"))


def _tree(node, feature) -> Column:
    """One regression tree as nested conditions."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return (F.when(feature(FEATURES[split.featureIndex()]) <= float(split.threshold()), _tree(node.leftChild(), feature))
            .otherwise(_tree(node.rightChild(), feature)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 20_000,
        sample_candidates: int = 20_000, precision: float = 0.98, trees: int = 12, depth: int = 3) -> dict | None:
    """Boosted trees and a threshold per kind, or None without both labels.

    At most about ``sample_docs`` documents and ``sample_candidates`` candidates
    of each label are used; every fourth document's are held out for the thresholds."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    some = docs.where(sampled(share, id_col, text_col))
    spans = _with_spans(some, id_col, text_col)
    others = (spans.select("id", F.explode("candidates").alias("c")).where("NOT c.sure").select("id", F.lit(0.0).alias("label"), *[F.col(f"c.{f}").alias(f) for f in FEATURES])
              .limit(sample_candidates))
    rows = others.union(_planted(spans).limit(sample_candidates)).withColumn("held", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 3)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows.select("label", "held", *FEATURES)).cache()
    try:
        labels = {r["label"]: r["n"] for r in rows.where("NOT held").groupBy("label").agg(F.count("*").alias("n")).collect()}
        if min(labels.get(0.0, 0), labels.get(1.0, 0)) < 5:
            return None
        model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=7, featuresCol="features").fit(rows.where("NOT held"))
        fitted = {"trees": list(zip(model.treeWeights, model.trees)), "cuts": {}}
        scored = rows.where("held").select("kind", "label", F.round(score(fitted, F.col), 3).alias("score"))
        # cumulated from the highest score down: at most a thousand scores a kind
        steps = scored.groupBy("kind", "score").agg(F.sum("label").alias("hits"), F.count("*").alias("n")).orderBy("kind", F.desc("score")).collect()
    finally:
        rows.unpersist()
    for k in range(len(KINDS)):
        hits = n = 0
        for r in [r for r in steps if r["kind"] == float(k)]:
            hits, n = hits + r["hits"], n + r["n"]
            if hits >= precision * n:
                fitted["cuts"][k] = r["score"]
    return fitted


def score(model: dict, feature) -> Column:
    """Probability of the boosted trees for the features that ``feature(name)`` gives."""
    margin = F.lit(0.0)
    for weight, tree in model["trees"]:
        margin = margin + F.lit(float(weight)) * _tree(tree._java_obj.rootNode(), feature)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def find_pii(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``, one row per document."""
    found = _with_spans(docs, id_col, text_col)

    def span(k, s, e) -> Column:
        return F.struct(s.cast("int").alias("s"), k.cast("int").alias("k"), e.cast("int").alias("e"))

    def spans_of(k: int) -> Column:
        return F.transform(F.col(KINDS[k]), lambda x: span(F.lit(k), x["s"], x["e"]))
    base = F.concat(*[spans_of(k) for k in range(len(KINDS))])
    added = F.expr("cast(array() AS array<struct<s:int,k:int,e:int>>)")
    if model and model["cuts"]:
        def chosen(c: Column) -> Column:
            cut = F.lit(2.0)
            for k, least in model["cuts"].items():
                cut = F.when(c["kind"] == float(k), F.lit(float(least))).otherwise(cut)
            return ~c["sure"] & (F.round(score(model, lambda f: c[f]), 3) >= cut)
        added = F.transform(F.filter("candidates", chosen), lambda c: span(c["kind"], c["s"], c["e"]))
    found = found.select("id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], base.alias("base"), added.alias("added"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("id", *[f"n_{k}" for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
