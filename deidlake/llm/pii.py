"""Personal data: fixed patterns, and information-theoretic sanitisation of
the words around them.

Patterns find e-mail addresses, IP addresses, card and phone numbers.  Each
value found is a protected entity.  A term near an entity (within
``CONTEXT_WORDS`` words) discloses it as far as the term predicts the entity:
with document counts n(e), n(t), n(e, t) over the whole corpus of N documents

    disclosure = log(N n(e, t) / (n(e) n(t))) / log(N / n(e))

which is 1 if the term never occurs without the entity and about 0 if it is
independent of it.  Terms above ``REMOVE`` are removed, those above
``GENERALISE`` are replaced by a general token; both only where they stand
near the entity.  Every pair has an estimate.  Counts of two and more are taken
as they are, as in Katz's smoothing; a pair seen in one document counts by Good
and Turing's estimate, twice the pairs seen in two documents by those seen in
one: where hardly any pair comes again, a single meeting is chance.

Shape of the job: one scan writes the spans and contexts (without the text)
to the shared folder.  A second scan counts the documents of the candidate
terms; candidates are told by a bit array of fixed size, and each task sends
a count per term instead of a row per word.  Spans are joined by id and text
hash, so the query never shuffles the text; only ``sanitise`` does.

Defined results: a null or empty text has no spans; null ids and repeated
rows are found by the hash of the text too, so each row gets its own spans;
overlapping spans of different kinds all count, and are replaced as one; an
empty table gives an empty result; extra columns are ignored by ``find`` and
kept by ``sanitise`` (which corrects ``n_chars`` if there is one)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deidlake.llm.common import PUNCTUATION, lower_ascii, mix64, pieces, small_batches, stored, unused, utf8, word_hashes, word_spans

#: Kinds in the order of results.
KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT_WORDS = 8
#: Least count of a pair seen once (where no pair comes twice).
LEAST_COUNT = 1e-9
GENERALISE, REMOVE = 0.8, 0.95
SHORTEST_TERM = 3
#: Bits of the array that tells candidate terms (512 KB).
FILTER_BITS = 22
#: Counts a task sums up before it sends them.
HELD_TERMS = 500_000

# ----------------------------------------------------------------- patterns
# The data contract's patterns, written so that they take linear time.

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each "@" to the left over the local part, to the right over the
    domain; a local part can't reach into the address before."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _ip_ok(found: str) -> bool:
    return all(len(x) <= 3 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in found.split(".")))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _card_ok(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(found: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", found)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    found = [(0, a, b) for a, b in emails(text)]
    for kind, pattern, ok in ((1, _IP, _ip_ok), (2, _CARD, _card_ok), (3, _PHONE, _phone_ok)):
        if kind == 3 and "+" not in text:
            continue
        found += [(kind, *m.span()) for m in pattern.finditer(text) if ok(m.group())]
    return found


def entity_of(kind: int, value: str) -> str:
    """The same person's data in the same spelling."""
    return value.lower() if kind == 0 else value if kind == 1 else _NOT_DIGIT.sub("", value)


_TERM = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contexts(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, str, int, int]]:
    """(index of the span, term, start, end) of the terms near each span,
    without those inside any span."""
    covered = sorted((a, b) for _, a, b in spans)
    starts = [a for a, _ in covered]
    furthest = []  # largest end up to each span
    for _, b in covered:
        furthest.append(max(b, furthest[-1] if furthest else 0))

    def free(a: int, b: int) -> bool:
        k = bisect_left(starts, b)
        return k == 0 or furthest[k - 1] <= a

    for index, (_, start, end) in enumerate(spans):
        reach = 256
        while True:  # far enough to hold the words wanted
            left = list(_TERM.finditer(text, max(0, start - reach), start))
            if len(left) > CONTEXT_WORDS or reach >= start:
                break
            reach *= 4
        right = []
        for m in _TERM.finditer(text, end):
            right.append(m)
            if len(right) == CONTEXT_WORDS:
                break
        for m in left[-CONTEXT_WORDS:] + right:
            if m.end() - m.start() >= SHORTEST_TERM and free(*m.span()):
                yield index, m.group().translate(_LOWER), *m.span()


def _hash_terms(terms: list[str]) -> np.ndarray:
    joined = [t.encode() for t in terms]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in joined])]).astype(np.int64)
    data = np.frombuffer(b"".join(joined), np.uint8)
    return word_hashes(data, offsets[:-1], offsets[1:]).view(np.int64) if len(terms) else np.zeros(0, np.int64)


# -------------------------------------------------------------------- Spark

_FOUND = ("id long, tie long, spans array<struct<kind:int,start:int,end:int,entity:long>>, "
          "context array<struct<entity:long,term:long,start:int,end:int>>")


def _tie(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans of every row, and the hashed terms around them."""
    text = F.col(f"`{text_col}`")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _tie(text).alias("tie"), text.cast("string").alias("text"))
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("entity", pa.int64())]))
    context_type = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, context = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                own = base_spans(text)
                near = list(contexts(text, own)) if own else []
                entities = _hash_terms([f"{k}:{entity_of(k, text[a:b])}" for k, a, b in own])
                spans.append([{"kind": k, "start": a, "end": b, "entity": int(e)} for (k, a, b), e in zip(own, entities)])
                terms = _hash_terms([t for _, t, _, _ in near])
                context.append([{"entity": int(entities[i]), "term": int(t), "start": a, "end": b}
                                for (i, _, a, b), t in zip(near, terms)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tie"), pa.array(spans, span_type), pa.array(context, context_type)],
                ["id", "tie", "spans", "context"])

    return source.mapInArrow(run, _FOUND)


def _slots(terms: np.ndarray) -> np.ndarray:
    return (mix64(terms.view(np.uint64), 5) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _document_counts(docs: DataFrame, text_col: str, candidates: DataFrame) -> DataFrame:
    """(term, n_term): number of documents with each candidate term."""

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(_slots(np.asarray(batch.column("term"), np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(slots)], ["slot"])

    # at most 2^22 numbers, whatever the corpus
    wanted = candidates.select("term").mapInArrow(to_slots, "slot long").distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[np.asarray(wanted.column("slot"), np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            values, which = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
            return values, np.bincount(which, np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in pieces(offsets):
                part = lower_ascii(data[offsets[i]:offsets[j]])
                start, end, first = word_spans(part, offsets[i:j + 1] - offsets[i], PUNCTUATION)
                term = word_hashes(part, start, end).view(np.int64)
                doc = np.repeat(np.arange(j - i), np.diff(first))
                wanted = bits[_slots(term)]
                term, doc = term[wanted], doc[wanted]
                _, once = np.unique(mix64(term.view(np.uint64)) + doc.astype(np.uint64), return_index=True)
                held.append(np.unique(term[once], return_counts=True))
                if sum(len(v) for v, _ in held) > HELD_TERMS:
                    held = [summed()]
                    if len(held[0][0]) > HELD_TERMS // 2:  # too many terms to keep for the whole task
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], ["term", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed()], ["term", "n"])

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosures(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """(entity, term, disclosure) of all pairs."""
    total = found.count()
    near = found.select(F.explode(F.array_distinct(F.transform("context", lambda c: F.struct(c["entity"], c["term"])))).alias("p"))
    pairs = near.groupBy("p.entity", "p.term").agg(F.count(F.lit(1)).alias("n_pair"))
    pairs = stored(pairs, "pairs")
    once, twice = pairs.agg(*[F.count_if(F.col("n_pair") == k) for k in (1, 2)]).first()
    single = min(1.0, max(2 * twice / max(once, 1), LEAST_COUNT))
    count = F.when(F.col("n_pair") == 1, single).otherwise(F.col("n_pair"))
    own = found.select(F.explode(F.array_distinct(F.transform("spans", lambda s: s["entity"]))).alias("entity"))
    entities = own.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    terms = _document_counts(docs, text_col, pairs)
    gain = F.log(F.lit(float(total)) * count / (F.col("n_entity") * F.col("n_term")))
    least = F.log(F.lit(float(total)) / F.col("n_entity"))
    share = F.when(least > 0, gain / least).otherwise(F.lit(0.0))
    return pairs.join(entities, "entity").join(terms, "term").select("entity", "term", share.alias("disclosure"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tie, spans) of every row; ``spans`` are (kind, start, end,
    action) by kind and start, ``tie`` is the hash of the text."""
    small_batches(docs.sparkSession)
    found = stored(_scan(docs, id_col, text_col), "pii-spans")
    risky = disclosures(docs, found, text_col).where(F.col("disclosure") >= GENERALISE)
    near = found.select("id", "tie", F.explode("context").alias("c")).select("id", "tie", "c.*")
    term = F.struct(
        F.lit(len(KINDS) - 1).alias("kind"), "start", "end",
        F.when(F.max("disclosure") >= REMOVE, "remove").otherwise("generalise").alias("action"))
    marked = near.join(risky, ["entity", "term"]).groupBy("id", "tie", "start", "end").agg(term.alias("term"))
    # the terms of one text
    by_row = marked.groupBy(F.col("id").alias("__id"), F.col("tie").alias("__tie")).agg(F.collect_list("term").alias("terms"))
    base = F.transform("spans", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit("replace").alias("action")))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,action:string>>")
    joined = found.join(by_row, F.col("id").eqNullSafe(F.col("__id")) & (F.col("tie") == F.col("__tie")), "left")
    return joined.select("id", "tie", F.sort_array(F.concat(base, F.coalesce("terms", none))).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS) - 1)
    return find(docs).select(
        F.col("id").alias("doc_id"), *[of(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:-1])],
        F.sha2(F.array_join(F.transform(base, line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"), of(len(KINDS) - 1).alias("n_term"))


def replaced(text: str, spans: list) -> str:
    """The text with overlapping or touching spans replaced as one, by the
    token of the first; removed terms leave nothing."""
    out, free = [], 0
    for start, end, kind, action in sorted((s["start"], s["end"], s["kind"], s["action"]) for s in spans):
        if start >= free:
            out.append(text[free:start])
            if action != "remove":
                out.append(f"[{KINDS[kind].upper()}]")
        free = max(free, end)
    return "".join([*out, text[free:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced."""
    spans = find(docs, id_col, text_col).where(F.size("spans") > 0)
    id_, tie, own, own_tie, found = unused(docs, "id", "tie", "own", "own_tie", "found")
    spans = spans.groupBy(F.col("id").alias(id_), F.col("tie").alias(tie)).agg(F.first("spans").alias(found))
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*names, F.col(f"`{id_col}`").cast("long").alias(own), _tie(F.col(f"`{text_col}`")).alias(own_tie))
    rows = keyed.join(spans, F.col(own).eqNullSafe(F.col(id_)) & (F.col(own_tie) == F.col(tie)), "left").select(*names, found)
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, columns = batch.column(found), [batch.column(i) for i in range(len(schema))]
            texts, lengths = columns[at].to_pylist(), columns[schema.names.index("n_chars")].to_pylist() if "n_chars" in schema.names else None
            for k in np.flatnonzero(np.asarray(spans.is_valid())).tolist():
                texts[k] = replaced(texts[k], spans[k].as_py())
                if lengths is not None:
                    lengths[k] = len(texts[k])
            columns[at] = pa.array(texts, columns[at].type)
            if lengths is not None:
                own = schema.names.index("n_chars")
                columns[own] = pa.array(lengths, columns[own].type)
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)
