"""Personal data by base patterns and bootstrapped contextual extraction.

Base patterns find e-mail addresses, IP addresses, card and phone numbers.
These are the seeds. The words around a seed are lexical patterns; around
identifier-like tokens that the base rules miss (a phone number without "+", a
card with a mistyped digit, an address in an odd form) stand patterns too.
Spark scores this graph of patterns and instances in turns: a pattern is as
good as the share of one kind among its distinct instances that are decided
(known, or not of that kind by their form; an instance that may be of the kind
counts as ``OPEN`` of one); an unknown instance is as good as the chance that one of its patterns is right.
High-confidence patterns make instances known, which may make further patterns
good, until nothing new is found.

Texts are scanned once; the rounds work on the graph of distinct (pattern,
instance) edges, which only texts with digits or "@" add to.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, ship, small_enough, written

KINDS = ("email", "ip", "card", "phone")
OPEN = 0.05  # so much of an error is an unknown instance that may be of the kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
# identifier-like tokens that may be personal data without meeting a base rule
_NUMBER = re.compile(r"[+(]?[0-9](?:[0-9 ().-]*[0-9])?")
_HOST = re.compile(r"[^\s@]{2,}")
_COLONS = re.compile(r"[0-9A-Fa-f:]{7,}")
_ADDRESS = re.compile(r"(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{1,4}")
_DIGITS = re.compile(r"[^0-9]+")

SPAN = "struct<start:int,kind:int,stop:int>"
SCAN = (f"key binary, doc_id long, base array<{SPAN}>, "
        "seen array<struct<start:int,stop:int,kind:int,instance:string,patterns:array<string>>>")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) by start, then kind: leftmost non-overlapping
    matches of each kind, without those that fail their check. In time linear
    in the text, also for long runs of digits or dots."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        i = at
        while i > free and text[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(text, at + 1) if i < at else None
        if m:
            out.append((i, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in _DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            parts, i = m[0].split("."), m.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                j = i + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out.append((i, 1, j))
                i = j + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _like(token: str) -> int:
    """The kinds that a token may be of, as bits."""
    digits = _DIGITS.sub("", token)
    if "@" in token:
        return 1
    if ":" in token or token.count(".") >= 3:
        return 2 if ":" in token or token.count(".") == 3 else 0
    return 4 * (13 <= len(digits) <= 19) + 8 * (7 <= len(digits) <= 15)


def tokens_like(text: str) -> list[tuple[int, int]]:
    """(start, stop) of the identifier-like tokens, leftmost and then longest
    first, without overlaps: whole runs of digits and their separators, of
    characters around "@", and of hexadecimal digits and colons. In time linear in
    the text."""
    out = [m.span() for m in _NUMBER.finditer(text) if m.end() - m.start() >= 7]
    at, free = text.find("@"), 0
    while at >= 0:
        i = at
        while i > free and not text[i - 1].isspace() and text[i - 1] != "@":
            i -= 1
        m = _HOST.match(text, at + 1) if i < at else None
        if m:
            out.append((i, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    if ":" in text:
        out += [m.span() for m in _COLONS.finditer(text) if _ADDRESS.fullmatch(text, *m.span())]
    kept, end = [], 0
    for i, j in sorted(out, key=lambda x: (x[0], -x[1])):
        if i >= end:
            kept.append((i, j))
            end = j
    return kept


def _word(w: str) -> str:
    return re.sub(r"[0-9]+", "#", w.strip(".,;:!?\"'()[]=*&%$#|<>-").lower())


def patterns_around(text: str, start: int, stop: int) -> list[str]:
    """The lexical patterns of a place: the word before, the two words before,
    and the words before and behind."""
    before = [_word(w) for w in text[max(0, start - 60):start].split()[-2:]]
    behind = [_word(w) for w in text[stop:stop + 40].split()[:1]]
    out = []
    if before and before[-1]:
        out.append(f"{before[-1]} _")
        if len(before) > 1:
            out.append(f"{before[0]} {before[1]} _")
        if behind and behind[0]:
            out.append(f"{before[-1]} _ {behind[0]}")
    return out


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple]]:
    """Base spans, and seeds (kind 0 to 3) and unknown tokens (kind -1 - bits
    of the kinds they may be of) with their patterns."""
    if not text or not _ANY.search(text):
        return [], []
    base = base_spans(text)
    seen = [(s, e, k, _key(text[s:e], k), patterns_around(text, s, e)) for s, k, e in base]
    first, last = [], 0  # base spans by start, and where the ones so far end
    for s, _, e in base:
        last = max(last, e)
        first.append((s, last))
    for i, j in tokens_like(text):
        bits = _like(text[i:j])
        before = bisect.bisect_left(first, (j,))
        if bits and not (before and first[before - 1][1] > i):
            seen.append((i, j, -1 - bits, _key(text[i:j]), patterns_around(text, i, j)))
    return base, seen


def _key(token: str, kind: int = -1) -> str:
    """Spellings of one instance alike, cards and phones by their digits."""
    return token.lower() if kind < 2 and ("@" in token or ":" in token or token.count(".") == 3) else (
        _DIGITS.sub("", token))


def _allows(bits: Column, kind: Column) -> Column:
    """Whether a token of these bits may be of the kind."""
    return bits.bitwiseAND(F.pow(F.lit(2), kind).cast("int")) > 0


def _scan(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([
            ("key", pa.binary()), ("doc_id", pa.int64()),
            ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))),
            ("seen", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.int32()),
                                         ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])))])
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                found = [scan_text(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([[dict(zip(("start", "kind", "stop"), b, strict=True)) for b in base]
                               for base, _ in found], fields.field(2).type),
                     pa.array([[dict(zip(("start", "stop", "kind", "instance", "patterns"), s, strict=True))
                                for s in seen] for _, seen in found], fields.field(3).type)],
                    schema=fields)
        give_back()

    rows = docs.select(_row_key(doc_id, text), F.col(doc_id).cast("long"), F.col(text))
    return rows.mapInArrow(scan, SCAN)


def _row_key(doc_id: str, text: str) -> Column:
    """128 bits of id and text together; a NULL id differs from every other."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text))))


def score_patterns(edges: DataFrame, known: DataFrame, least_support: int,
                   least_share: float) -> DataFrame:
    """(pattern, kind, confidence) of patterns with ``least_support`` distinct
    instances known to be of one kind, and a share of ``least_share`` of it
    among those that are known, or of another kind by their form. Unknown ones
    that may be of the kind are what a pattern is to discover: each counts as
    ``OPEN``, so that only very many of them (dates behind "on") speak
    against it."""
    kinds = edges.groupBy("pattern", "instance").agg(F.max(-1 - F.col("kind")).alias("bits")).join(
        known, "instance", "left")
    unknown = F.col("kind").isNull()
    per = kinds.groupBy("pattern").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("kind") == k).alias(f"k{k}") for k in range(len(KINDS))],
        *[F.count_if(unknown & _allows(F.col("bits"), F.lit(k))).alias(f"open{k}") for k in range(len(KINDS))])
    best = F.greatest(*[F.struct(F.col(f"k{k}").alias("n"), F.lit(k).alias("kind"), F.col(f"open{k}").alias("open"))
                        for k in range(len(KINDS))])
    per = per.withColumn("best", best).withColumn(
        "confidence", F.col("best.n") / (F.col("n") - (1 - OPEN) * F.col("best.open")))
    return per.where((F.col("best.n") >= least_support) & (F.col("confidence") >= least_share)).select(
        "pattern", F.col("best.kind").alias("kind"), "confidence")


def bootstrap(occurrences: DataFrame, *, rounds: int | None, least_support: int, least_share: float,
              least_instance: float) -> DataFrame | None:
    """(instance, kind) of the identifiers among the unknown tokens: those that
    are other spellings of a seed, and the unseen ones that high-confidence
    patterns discover. None if there are none. ``occurrences``: kind, instance,
    patterns."""
    edges = written(occurrences.select("kind", "instance", F.explode("patterns").alias("pattern")).distinct(),
                    "pii-edges")
    # of all occurrences: a seed without words before it has no edge
    known = written(occurrences.where("kind >= 0").groupBy("instance").agg(F.min("kind").alias("kind")),
                    "pii-known")
    seeds = written(known.join(occurrences.where("kind < 0").select("instance").distinct(), "instance",
                               "left_semi"), "pii-seeds")
    open_edges = edges.where("kind < 0").select(
        (-1 - F.col("kind")).alias("bits"), "instance", "pattern").join(known, "instance", "left_anti")
    found: DataFrame | None = None
    for _ in range(rounds) if rounds is not None else itertools.count():
        good = score_patterns(edges, known, least_support, least_share)
        good = small_enough(written(good, "pii-patterns"))
        fits = _allows(F.col("bits"), F.col("kind"))
        # 1 - product of (1 - confidence); a pattern without any exception counts as 0.99
        doubt = F.log(F.greatest(1 - F.col("confidence"), F.lit(0.01)))
        scored = open_edges.join(good, "pattern").where(fits).groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(doubt))).alias("score")).where(F.col("score") >= least_instance)
        new = scored.groupBy("instance").agg(F.max(F.struct("score", -F.col("kind"))).alias("b")).select(
            "instance", (-F.col("b.col2")).cast("int").alias("kind"))
        if found is not None:
            new = new.join(found, "instance", "left_anti")
        new = written(new, "pii-found")
        if not new.limit(1).count():
            break
        found = new if found is None else written(found.unionByName(new), "pii-found")
        known = written(known.unionByName(new), "pii-known")
    if seeds.limit(1).count():
        found = seeds if found is None else seeds.unionByName(found)
    return found


def find_pii(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rounds: int | None = None,
             least_support: int = 5, least_share: float = 0.8, least_instance: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, key (128 bits of a hash of id and text), base
    and spans, both lists of (start, kind, stop) in code points, by start and
    then kind (a place in ``KINDS``). ``spans`` holds ``base`` and what the
    patterns add, which never overlaps a base span. Every spelling of a seed is
    marked wherever it occurs. Discovery goes on until a round finds nothing new,
    unless ``rounds`` says how many there are to be.

    A NULL or empty text has no spans. Repeated rows get equal results. An
    empty table gives an empty one. Other columns are not read."""
    ship(docs.sparkSession)
    rows = written(_scan(docs, doc_id, text), "pii-rows")
    places = rows.where(F.size("seen") > 0).select("key", F.explode("seen").alias("o")).select("key", "o.*")
    found = bootstrap(places, rounds=rounds, least_support=least_support, least_share=least_share,
                      least_instance=least_instance)
    out = rows.select("doc_id", "key", "base", F.col("base").alias("spans"))
    if found is None:
        return out
    unknown = places.where("kind < 0").select("key", "start", "stop", "instance", (-1 - F.col("kind")).alias("bits"))
    added = unknown.join(small_enough(found), "instance").where(
        _allows(F.col("bits"), F.col("kind"))).groupBy("key").agg(F.collect_set(F.struct(
            F.col("start"), F.col("kind"), F.col("stop"))).alias("added"))
    return rows.join(added, "key", "left").select(
        "doc_id", "key", "base", F.sort_array(F.concat("base", F.coalesce(
            "added", F.array().cast(f"array<{SPAN}>")))).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:stop, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def mask_pii(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with every span replaced by its kind, such as ``<EMAIL>``. NULL
    stays NULL, repeated rows stay, and an empty table gives an empty one. All
    other columns stay as they are, whatever their names."""
    found = find_pii(docs, doc_id=doc_id, text=text, **options).where(F.size("spans") > 0).select(
        F.col("key").alias("_key"), "spans").dropDuplicates(["_key"])
    found = written(found, "pii-spans")

    @F.pandas_udf("string")
    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(t: str, ss) -> str:
            out, at = [], 0
            for s in ss:
                if s["start"] >= at:
                    out += [t[at:s["start"]], f"<{KINDS[s['kind']].upper()}>"]
                at = max(at, s["stop"])
            return "".join([*out, t[at:]])
        return pd.Series([one(t, s) if s is not None else t for t, s in zip(texts, spans, strict=True)])

    # the row travels as one column, so that no name of its own is taken
    whole = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"), _row_key(doc_id, text).alias("_key"))
    # lists of any length: their spans are counted, and not only the rows
    rows, places = found.agg(F.count("*"), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
    if rows <= 500_000 and places <= 2_000_000:  # under 100 MB
        found = F.broadcast(found)
    marked = whole.join(found, "_key", "left")
    # texts without spans don't go through Python
    plain = marked.where(F.col("spans").isNull()).select("row.*")
    hit = marked.where(F.col("spans").isNotNull()).withColumn("t", mask("t", "spans"))
    same = [F.col("t") if c == text else F.col("row").getField(c) for c in docs.columns]
    return plain.unionByName(hit.select(*[x.alias(c) for x, c in zip(same, docs.columns, strict=True)]))
