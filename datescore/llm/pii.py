"""PII (2): bootstrapped contextual extraction of personal identifiers.

Seeds are the entities that fixed forms find in every text: e-mail addresses,
IP addresses, payment cards (Luhn) and phone numbers. Around each seed, and around each
other token or run of digit groups that looks like an identifier, the lexical context induces
patterns: the two words before it, the words on both sides, or the key before
``=`` or ``:``. Patterns and the instances they surround form a bipartite
graph that Spark scores for a few rounds: a pattern's confidence for a kind is
the mean score of its instances, an instance's score is that of its best
trusted pattern. Trusted patterns then find identifiers that no fixed form
knows, in a second scan.

At scale: both scans are without a shuffle of texts; the graph holds one
row per distinct (pattern, instance) and is aggregated before it is shuffled.
All trusted patterns count at any size. Up to MAX_PATTERNS are broadcast; of more,
those with most support are, and the other contexts of the candidates are joined
to the table of patterns by shuffle (masking then shuffles the texts once).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datescore.llm.common import arrow_schema, column, slices, texts_of, to_python, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
TRUST = 0.7  # confidence from which a pattern is trusted
MIN_SEEDS = 3  # distinct seeds a trusted pattern surrounds
MAX_PATTERNS = 50_000  # trusted patterns that are broadcast

# The base forms of the contract. The quantifiers that cannot
# give back characters are possessive, so that long runs are read once.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
# Digit groups with separators of the contract between them, not cut out of a longer token.
_GROUP = r"[0-9]++(?![^\s().\-\"'\]}>,;:!?])"
_RUN = re.compile(rf"(?<![^\s=:\"'(\[{{<+]){_GROUP}(?:[ ().-]++{_GROUP})+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping: the longest run of local characters before each ``@``."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return out


def _part(p: str) -> bool:
    """Whether a part of an address is at most 255."""
    p = p.lstrip("0")
    return len(p) < 3 or (len(p) == 3 and p <= "255")


def base_spans(text: str) -> list[Span]:
    """Entities of the fixed forms, by kind as listed and then by start (code points, end exclusive).

    A match that fails its kind's check is dropped and not tried again.
    """
    out = _emails(text)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(map(_part, m.group().split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = "".join(_DIGIT.findall(m.group()))
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def digit_runs(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Longest runs of digit groups, at least five digits, with a space or bracket between them.

    The text between the fixed forms is read; a bracket or ``+`` at an end that belongs to the run is of it.
    """
    out, at = [], 0
    for a, b in [*sorted((s, e) for _, s, e in base), (len(text), len(text))]:
        for m in _RUN.finditer(text, at, a) if at < a else ():
            start, end = m.span()
            run = m.group()
            if not any(c in run for c in " ()") or len(_DIGIT.findall(run)) < 5:
                continue
            depth = lowest = 0
            for c in run:
                depth += (c == "(") - (c == ")")
                lowest = min(lowest, depth)
            if lowest < 0 and start > at and text[start - 1] == "(":
                start -= 1
                depth += 1
            if start > at and text[start - 1] == "+":
                start -= 1
            if depth > 0 and text[end : end + 1] == ")" and end < a:
                end += 1
            out.append((start, end))
        at = max(at, b)
    return out


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Other spans that look like identifiers: single tokens and ``digit_runs``.

    A token is what stands between white space, after the last ``=``, ``:``
    or quote in it and without punctuation at its ends: at least five characters, with a digit or ``@``.
    """
    if not _MARK.search(text):
        return []
    return list(dict.fromkeys(_tokens(text, base) + digit_runs(text, base)))


def _tokens(text: str, base: list[Span]) -> list[tuple[int, int]]:
    taken = sorted((s, e) for _, s, e in base)
    out, at, k = [], 0, 0
    while m := _MARK.search(text, at):
        start, end = m.start(), m.end()
        while start > at and not text[start - 1].isspace() and text[start - 1] not in "=:\"'([{<":
            start -= 1
        while end < len(text) and not text[end].isspace() and text[end] not in "\"')]}>":
            end += 1
        at = end
        while end > start and text[end - 1] in ".,;:!?":
            end -= 1
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        free = all(e <= start or s >= end for s, e in taken[max(0, k - 4) : k + 8])
        if end - start >= 5 and free:
            out.append((start, end))
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: two words before, a word on each side, key before ``=`` or ``:``."""
    before = _WORD.findall(text[max(0, start - 80) : start])
    after = _WORD.search(text[end : end + 48])
    out = []
    left = [w.lower()[-32:] for w in before[-2:]]
    if len(left) == 2:
        out.append("before " + " ".join(left))
    if left and after:
        out.append("around " + left[-1] + " _ " + after.group().lower()[:32])
    key = re.search(r"([A-Za-z_]{2,32})\s?[=:]\s?[\"']?$", text[max(0, start - 40) : start])
    if key:
        out.append("key " + key.group(1).lower())
    return out


# --- the graph --------------------------------------------------------------------------


def _instance(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.lower().encode(), digest_size=8).digest(), "big", signed=True)


EDGES = "pattern string, instance bigint, kind string"


def edges(docs: DataFrame) -> DataFrame:
    """Distinct (pattern, instance, kind) of all texts; kind null where no fixed form matched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(EDGES)
        for batch in slices(batches, "text"):
            rows = set()
            for text in texts_of(batch):
                base = base_spans(text)
                found = base + [(None, *c) for c in candidates(text, base)]
                for kind, start, end in found:
                    instance = _instance(text[start:end])
                    rows.update((p, instance, kind) for p in contexts(text, start, end))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, f.type) for values, f in zip(zip(*rows), schema)], schema=schema
                )

    return to_python(docs.select("text")).mapInArrow(run, EDGES).distinct()


def pattern_table(docs: DataFrame, rounds: int = ROUNDS, trust: float = TRUST, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """All patterns (pattern, kind, n, c) and the kind each is trusted for, by rounds over the pattern-instance graph."""
    graph = written(edges(docs), "pii-edges")
    seeds = graph.where("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    links = graph.select("pattern", "instance").distinct()
    sizes = links.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    scores, patterns = seeds, None
    for _ in range(rounds):
        sums = links.join(scores, "instance").groupBy("pattern", "kind").agg(
            F.sum("score").alias("s"), F.sum(F.when(F.col("score") >= 1, 1).otherwise(0)).alias("seeds")
        )
        confident = sums.join(sizes, "pattern").withColumn("confidence", F.col("s") / (F.col("n") + 1))
        confident = confident.where((F.col("confidence") >= trust) & (F.col("seeds") >= min_seeds))
        patterns = written(confident.select("pattern", "kind", "confidence", "n"), "pii-patterns")
        reached = links.join(patterns, "pattern").groupBy("instance", "kind").agg(F.max("confidence").alias("score"))
        scores = written(
            seeds.unionByName(reached).groupBy("instance", "kind").agg(F.max("score").alias("score")), "pii-scores"
        )
    best = patterns.groupBy("pattern").agg(
        F.max_by("kind", F.struct("confidence", "kind")).alias("kind"), F.max("n").alias("n"), F.max("confidence").alias("c")
    )
    return written(best, "pii-trusted")


def trusted_patterns(
    docs: DataFrame, rounds: int = ROUNDS, trust: float = TRUST, min_seeds: int = MIN_SEEDS, most: int = MAX_PATTERNS
) -> dict[str, str]:
    """The trusted patterns with most support, at most ``most``, and their kinds."""
    return _most_support(pattern_table(docs, rounds, trust, min_seeds), most)


def _most_support(table: DataFrame, most: int) -> dict[str, str]:
    rows = table.orderBy(F.desc("n"), F.desc("c"), "pattern").limit(most).collect()
    return {r.pattern: r.kind for r in rows}


# --- extraction ---------------------------------------------------------------------------


def found_spans(text: str, patterns: dict[str, str]) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those that a trusted pattern adds."""
    base = base_spans(text)
    added = []
    if patterns:
        for start, end in candidates(text, base):
            kinds = [patterns[p] for p in contexts(text, start, end) if p in patterns]
            if kinds:
                added.append((_most_named(kinds), start, end))
    return base, _in_order(base + _outermost(added))


def _outermost(spans: list[Span]) -> list[Span]:
    """Without the spans that lie inside another: a token of a found run is not an identifier of its own."""
    out, reach = [], -1
    for s in sorted(spans, key=lambda s: (s[1], -s[2])):
        if s[2] > reach:
            out.append(s)
            reach = s[2]
    return out


def _most_named(kinds: list[str]) -> str:
    return max(set(kinds), key=lambda k: (kinds.count(k), -KINDS.index(k)))


def _in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_ASKED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kinds", pa.list_(pa.string())), ("rest", pa.list_(pa.string()))]))
_FIELDS = "_pii_base array<struct<kind:string,start:int,end:int>>, _pii_asked array<struct<start:int,end:int,kinds:array<string>,rest:array<string>>>"


def _with_all_patterns(rows: DataFrame, table: DataFrame, most: int, keep_text: bool) -> DataFrame:
    """``rows`` (with ``text``, dropped unless ``keep_text``) and what ``_all_spans`` reads: found with a table of any size.

    Contexts that the broadcast patterns do not hold are looked up in ``table`` by shuffle; each
    candidate has the kind that it would have with all patterns in one place.
    """
    hot = _most_support(table, most)
    columns = [c for c in rows.columns if keep_text or c != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33  # unique in the written table: the partition and a running number
        for batch in slices(batches, "text"):
            bases, asked = [], []
            for text in texts_of(batch):
                base = base_spans(text)
                bases.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
                found = []
                for start, end in candidates(text, base):
                    around = contexts(text, start, end)
                    kinds = [hot[p] for p in around if p in hot]
                    found.append({"start": start, "end": end, "kinds": kinds, "rest": [p for p in around if p not in hot]})
                asked.append(found)
            arrays = [column(batch, c) for c in columns]
            arrays += [pa.array(range(uid, uid + len(bases)), pa.int64()), pa.array(bases, _SPANS), pa.array(asked, _ASKED)]
            uid += len(bases)
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "_pii_uid", "_pii_base", "_pii_asked"])

    kept = rows.select(*columns)
    fields = T.StructType([*kept.schema, T.StructField("_pii_uid", T.LongType())])
    for f in T.StructType.fromDDL(_FIELDS):
        fields = fields.add(f)
    first = written(to_python(rows).mapInArrow(scan, fields), "pii-candidates")
    asked = first.select("_pii_uid", F.inline("_pii_asked")).select("_pii_uid", "start", "end", F.explode("rest").alias("pattern"))
    hits = asked.join(table.select("pattern", "kind"), "pattern")
    hits = hits.groupBy("_pii_uid").agg(F.collect_list(F.struct("start", "end", "kind")).alias("_pii_hits"))
    return first.join(hits, "_pii_uid", "left").drop("_pii_uid")


def _all_spans(batch: pa.RecordBatch) -> list[list[Span]]:
    """Spans of each row from what ``_with_all_patterns`` found."""
    out = []
    for base, asked, hits in zip(*(column(batch, c).to_pylist() for c in ("_pii_base", "_pii_asked", "_pii_hits"))):
        named: dict[tuple[int, int], list[str]] = {}
        for h in hits or []:
            named.setdefault((h["start"], h["end"]), []).append(h["kind"])
        spans = []
        for c in asked:
            kinds = c["kinds"] + named.get((c["start"], c["end"]), [])
            if kinds:
                spans.append((_most_named(kinds), c["start"], c["end"]))
        out.append(_in_order([(b["kind"], b["start"], b["end"]) for b in base] + _outermost(spans)))
    return out


def _model(docs: DataFrame, most: int) -> tuple[dict[str, str] | None, DataFrame | None]:
    """The trusted patterns to broadcast, or their table if they are more than ``most``."""
    table = pattern_table(docs)
    return (None, table) if table.count() > most else (_most_support(table, most), None)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


RESULT = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def extract(docs: DataFrame, patterns: dict[str, str] | None = None, most: int = MAX_PATTERNS) -> DataFrame:
    """Personal data of every row: base counts and digest, and all spans.

    Null and empty texts have no spans. Rows are independent: repeated or null
    doc_ids are rows like any other; other columns are not read. ``patterns``
    come from ``trusted_patterns`` (by default all that are learnt from
    ``docs``, of which at most ``most`` are broadcast).
    """
    table = None
    if patterns is None:
        patterns, table = _model(docs, most)

    def rows(batch: pa.RecordBatch, found: list[tuple[list[Span], list[Span]]]) -> pa.RecordBatch:
        schema = arrow_schema(RESULT)
        out = []
        for base, spans in found:
            kinds = [k for k, _, _ in base]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            out.append((*map(kinds.count, KINDS), digest, _joined(spans)))
        arrays = [column(batch, "doc_id").cast(pa.int64())]
        arrays += [pa.array(values, f.type) for values, f in zip(zip(*out), list(schema)[1:])]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield rows(batch, [found_spans(text, patterns) for text in texts_of(batch)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bases = [[(b["kind"], b["start"], b["end"]) for b in base] for base in column(batch, "_pii_base").to_pylist()]
                yield rows(batch, list(zip(bases, _all_spans(batch))))

    texts = docs.select("doc_id", "text")
    if table is None:
        return to_python(texts).mapInArrow(run, RESULT)
    return to_python(_with_all_patterns(texts, table, most, keep_text=False)).mapInArrow(finish, RESULT)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first stands."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_documents(docs: DataFrame, patterns: dict[str, str] | None = None, most: int = MAX_PATTERNS) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and, where there is one, ``n_chars`` counted again.

    All rows stay, with their other columns; a null text stays null.
    """
    table = None
    if patterns is None:
        patterns, table = _model(docs, most)

    def put(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = column(batch, "text").to_pylist()
            yield put(batch, [None if t is None else masked(t, found_spans(t, patterns)[1]) for t in texts])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = zip(column(batch, "text").to_pylist(), _all_spans(batch))
            done = put(batch, [None if t is None else masked(t, spans) for t, spans in texts])
            yield done.select(names)

    names = docs.columns
    if table is None:
        out = to_python(docs).mapInArrow(run, docs.schema)
    else:
        out = to_python(_with_all_patterns(docs, table, most, keep_text=True)).mapInArrow(finish, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
