"""Information-theoretic sanitisation of personal data.

Four kinds of personal data are found by pattern: the protected entities, each by its
normalised value. How strongly a term reveals an entity is estimated from the corpus: with
document frequencies c(t), c(e), joint frequency c(t, e) (both stand in the document,
wherever) and N documents,

    PMI(e; t) = log2(N (c(t, e) - 1/2) / (c(t) c(e)))      IC(e) = log2(N / c(e))

where half a document less is the continuity correction: a few joint documents count for
less than they seem to. A term discloses the entity when PMI(e; t) >= alpha * IC(e). The
inequality itself bounds how common such a term is: c(t) <= N^(1 - alpha) c(e)^alpha. From
``GENERALISE`` on its occurrences are generalised (to ``[TERM]``), from ``REMOVE`` on they are
removed. The four patterns are always generalised to their kind.

What so few documents can tell differs. An entity with at least ``SUPPORT`` documents discloses
itself by terms that stand with it in as many; these are marked in all documents. For one
in fewer documents every rare word of them would fit, so only terms within ``WINDOW`` words of
a mention count for it, and only those places are marked, in its own documents.

Words that touch personal data are no terms, there or in c(t). Scale: one pass counts terms
and entities, a second counts pairs in the documents with personal data. Entities that stand
in the same documents are alike for their terms, so one of them, by a signature of its set of
documents, stands for the others: a list of contacts that is copied gives pairs in proportion
to its length. A pair is made only if the term may be rare enough by the inequality; the up to
``LISTED`` most frequent terms and entities are broadcast with their counts for this, others
count as rare, and exact joins decide afterwards. What tasks test membership with are Bloom
filters, sized by the counted keys up to ``MOST_BITS``; joins remove their false hits. Counts are
summed per task before the shuffle, so a hot entity or term is one row for each task. Of the terms
that are marked everywhere the ``LISTED`` most frequent are broadcast with their actions, and their
places stay in the document's own row; only rarer ones, and those of single entities, make rows to join.

Defined cases: null text is empty; every row counts as a document, repeated rows too; null
ids are kept; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finquarry.llm.common import joined_spans, slices, stored, table, texts

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "generalise", "remove"]
SUPPORT, GENERALISE, REMOVE, WINDOW = 3, 0.85, 0.97, 5
LEAST_BITS, MOST_BITS, BITS_PER_KEY = 1 << 16, 1 << 27, 16  # of a Bloom filter: 16 MB at most
LISTED, LONGEST = 1 << 16, 100  # terms and entities that are broadcast with their counts, and their code points at most
FLUSH = 200_000  # distinct keys a task holds before it hands its counts on

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"\w{3,}")
DIGIT = re.compile(r"[0-9]")

SPAN = "struct<kind:string,start:bigint,end:bigint>"
_span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@`` outwards, which gives the leftmost matches without scanning from every letter."""
    done, seen, at = 0, 0, text.find("@")
    while at >= 0:
        before = text[max(done, seen) : at]
        user = len(before) - len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at) if user else None
        if m:
            yield at - user, m.end()
            done = m.end()
        seen = at + 1
        at = text.find("@", max(seen, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def find_personal(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of the four kinds, each leftmost and non-overlapping."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGIT.findall(m.group())) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else ''.join(DIGIT.findall(value))}"


def _outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match]:
    """The words that touch no span, in order."""
    ordered, i, end = sorted((a, b) for _, a, b in spans), 0, 0
    for w in TERM.finditer(text):
        while i < len(ordered) and ordered[i][0] < w.end():
            end = max(end, ordered[i][1])
            i += 1
        if w.start() >= end:
            yield w


def _entities(text: str, spans: list[tuple[str, int, int]]) -> set[str]:
    return {_entity(kind, text[a:b]) for kind, a, b in spans}


def _terms(text: str, spans: list[tuple[str, int, int]]) -> set[str]:
    if spans:
        return {m.group().lower() for m in _outside(text, spans)}
    return set(TERM.findall(text.lower())) if text.isascii() else {w.lower() for w in set(TERM.findall(text))}


def _near(text: str, spans: list[tuple[str, int, int]], entities: set[str]) -> dict[str, dict[str, set[tuple[int, int]]]]:
    """For each of the entities the terms within ``WINDOW`` words of a mention, with their places."""
    words = list(_outside(text, spans))
    starts, out = [w.start() for w in words], {}
    for kind, a, b in spans:
        e = _entity(kind, text[a:b])
        if e in entities:
            i, j = bisect_left(starts, a), bisect_left(starts, b)
            places = out.setdefault(e, {})
            for w in [*words[max(0, i - WINDOW) : i], *words[j : j + WINDOW]]:
                places.setdefault(w.group().lower(), set()).add((w.start(), w.end()))
    return out


COUNTS = pa.schema([("of_entity", pa.bool_()), ("key", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _single_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of entities and terms, and for entities a signature of their documents."""
    from pyspark import TaskContext

    terms: Counter = Counter()
    entities: dict[str, list[int]] = {}
    row = TaskContext.get().partitionId() << 33

    def rows():
        keys, n = [*entities, *terms], len(entities)
        columns = [[True] * n + [False] * len(terms), keys, [*(e[0] for e in entities.values()), *terms.values()], [*(e[1] for e in entities.values()), *[0] * len(terms)]]
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, COUNTS)], schema=COUNTS)
        terms.clear()
        entities.clear()
        return out

    for b in slices(batches):
        for text in texts(b.column("text")):
            row += 1
            spans = find_personal(text)
            if spans:
                mark = xxhash.xxh3_64_intdigest(row.to_bytes(8)) >> 1
                for e in _entities(text, spans):
                    held = entities.setdefault(e, [0, 0])
                    held[0], held[1] = held[0] + 1, held[1] ^ mark
            terms.update(_terms(text, spans))
            if len(terms) > FLUSH or len(entities) > FLUSH:
                yield rows()
    yield rows()


PAIRS = pa.schema([("near", pa.bool_()), ("entity", pa.string()), ("term", pa.string()), ("n", pa.int64())])


def _pair_counts(known, total: int, share: float):
    """Joint document frequencies of an entity and the terms that may be rare enough to disclose it; the others, with terms near a mention."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, entities, rest, common = known.value
        frequent = Bloom(bits)
        held: Counter = Counter()

        def rows():
            columns = [*zip(*held), held.values()] if held else [[], [], [], []]
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, PAIRS)], schema=PAIRS)
            held.clear()
            return out

        for b in slices(batches):
            for text in texts(b.column("text")):
                spans = find_personal(text)
                if not spans:
                    continue
                found, terms = _entities(text, spans), _terms(text, spans)
                many = {e for e in found if frequent[e]}
                for e in many:
                    c_e = entities.get(e, rest if len(e) <= LONGEST else total)
                    bound = total ** (1 - share) * c_e**share * (1 + 1e-9)
                    for some in batched(((False, e, w) for w in terms if common.get(w, 1) <= bound), FLUSH):
                        held.update(some)
                        if len(held) > FLUSH:
                            yield rows()
                for e, places in _near(text, spans, found).items():  # also of frequent ones: the filter may be wrong
                    held.update((True, e, w) for w in places if common.get(w, 1) <= total ** (1 - share) * SUPPORT**share)
                if len(held) > FLUSH:
                    yield rows()
        yield rows()

    return run


def _least(counts: dict[int, int]) -> int:
    """The least power of two, from 2 on, that at most ``LISTED`` frequencies reach; counts: by bits of the frequency."""
    least, reached = 1 << 63, 0
    for bits in range(63, 1, -1):
        reached += counts.get(bits, 0)
        if reached > LISTED:
            break
        least = 1 << bits - 1
    return least


class Bloom(dict):
    """Two bits for each key in an array; remembers the answers for keys it was asked, up to a bound."""

    HELD = 200_000

    def __init__(self, bits: np.ndarray):
        super().__init__()
        self.bits, self.size = memoryview(bits), len(bits) * 8

    @staticmethod
    def places(key: str, size: int) -> tuple[int, int]:
        h = xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))
        return h % size, (h >> 32) % size

    def __missing__(self, key: str) -> bool:
        a, b = self.places(key, self.size)
        hit = bool(self.bits[a >> 3] >> (a & 7) & 1 and self.bits[b >> 3] >> (b & 7) & 1)
        if len(key) <= LONGEST:
            if len(self) > self.HELD:
                self.clear()
            self[key] = hit
        return hit

    @staticmethod
    def of(keys: DataFrame) -> np.ndarray:
        """Bits for a one-column frame, by its number of rows; at most ``MOST_BITS`` / 8 bytes come to the driver."""
        size, wanted = LEAST_BITS, keys.count() * BITS_PER_KEY
        while size < min(wanted, MOST_BITS):
            size *= 2

        def bits(batches):
            made = np.zeros(size // 8, np.uint8)
            for b in batches:
                for t in b.column(0).to_pylist():
                    for p in Bloom.places(t, size):
                        made[p >> 3] |= 1 << (p & 7)
            at = np.flatnonzero(made)
            yield pa.record_batch([pa.array(at, pa.int64()), pa.array(made[at], pa.int64())], names=["at", "bits"])

        found = keys.mapInArrow(bits, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
        out = np.zeros(size // 8, np.uint8)
        out[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.uint8)
        return out


def disclosing_terms(docs: DataFrame, text_col: str = "text", generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """Terms that reveal a protected entity: entity, term, action, share (PMI / IC), docs (documents with the term).

    The entity is null where it has enough documents: the term is then marked everywhere, with
    the largest share of any entity. Otherwise it is marked near mentions of the entity.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(text_col).alias("text"))
    single = slim.mapInArrow(_single_counts, "of_entity boolean, key string, n bigint, docs bigint")
    counts = stored(single.groupBy("of_entity", "key").agg(F.sum("n").alias("n"), F.bit_xor("docs").alias("docs")), "pii-counts")
    total = docs.count()
    levels = counts.groupBy("of_entity", F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("keys")).collect()
    least_e, least_t = (_least({r.bits: r["keys"] for r in levels if r.of_entity == kind}) for kind in (True, False))
    listed = counts.filter(F.length("key") <= LONGEST).filter(F.col("n") >= F.when(F.col("of_entity"), least_e).otherwise(least_t)).collect()
    frequent = [{r.key: r.n for r in listed if r.of_entity == kind} for kind in (True, False)]
    # one entity for each set of documents
    first = counts.filter(F.col("of_entity") & (F.col("n") >= support)).groupBy("n", "docs").agg(F.min("key").alias("key"))
    alike = Bloom.of(first.select("key"))
    known = spark.sparkContext.broadcast((alike, frequent[0], least_e - 1, frequent[1]))
    pairs = slim.mapInArrow(_pair_counts(known, total, generalise), "near boolean, entity string, term string, n bigint").groupBy("near", "entity", "term").agg(F.sum("n").alias("n"))
    terms = counts.filter("not of_entity").select(F.col("key").alias("term"), F.col("n").alias("c_t"))
    many = first.select(F.lit(False).alias("near"), F.col("key").alias("entity"), F.col("n").alias("c_e"))
    few = counts.filter(F.col("of_entity") & (F.col("n") < support)).select(F.lit(True).alias("near"), F.col("key").alias("entity"), F.col("n").alias("c_e"))
    n = F.col("n") - 0.5
    share = (F.lit(float(total)) * n / (F.col("c_t") * F.col("c_e")), F.lit(float(total)) / F.col("c_e"))
    enough = F.col("n") >= F.least(F.lit(support), F.col("c_e"))
    scored = pairs.join(many.union(few), ["near", "entity"]).filter(enough).join(terms, "term").filter(share[1] > 1).select(F.when(F.col("near"), F.col("entity")).alias("entity"), "term", (F.log2(share[0]) / F.log2(share[1])).alias("share"), "c_t")
    best = scored.groupBy("entity", "term").agg(F.max("share").alias("share"), F.max("c_t").alias("docs")).filter(F.col("share") >= generalise)
    return best.select("entity", "term", F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"), "share", "docs")


MARKS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("entity", pa.string()), ("term", pa.string()), ("spans", pa.list_(_span)), ("added", pa.list_(_span)), ("text", pa.string())])


def _marked(known, with_text):
    """Per document one row with its base spans and those of listed terms, and one row for each other term, or entity and term, that may be disclosing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        listed, *bits = known.value
        everywhere, local, first, at = *map(Bloom, bits), TaskContext.get().partitionId() << 33, 0
        as_structs = lambda spans: [dict(zip(("kind", "start", "end"), s)) for s in spans]
        for b in slices(batches):
            out = []
            for doc_id, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                row, at = first + at, at + 1
                base = find_personal(t)
                hits = {w for w in _terms(t, base) if w in listed or everywhere[w]}
                places: dict[str, list] = {}
                for m in _outside(t, base) if hits else ():
                    w = m.group().lower()
                    if w in hits:
                        places.setdefault(w, []).append((listed.get(w), m.start(), m.end()))
                added = [p for w, ps in places.items() if w in listed for p in ps]
                out.append((row, doc_id, None, None, as_structs(base), as_structs(added), t if with_text else None))
                out += [(row, doc_id, None, w, as_structs(ps), None, None) for w, ps in places.items() if w not in listed]
                for e, terms in _near(t, base, _entities(t, base)).items() if base else ():
                    out += [(row, doc_id, e, w, as_structs((None, *p) for p in sorted(ps)), None, None) for w, ps in terms.items() if local[f"{e} {w}"]]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), MARKS)], schema=MARKS)

    return run


def _listed(terms: DataFrame) -> tuple[dict[str, str], DataFrame]:
    """Of the terms that are marked everywhere the up to ``LISTED`` most frequent, with their actions, and a frame of the others."""
    short = terms.filter(F.col("entity").isNull() & (F.length("term") <= LONGEST))
    most = short.orderBy(F.desc("docs"), "term").limit(LISTED).select("term", "action", "docs").collect()
    rest = terms.filter("entity is null")
    if most:
        last = most[-1]
        taken = (F.length("term") <= LONGEST) & ((F.col("docs") > last.docs) | ((F.col("docs") == last.docs) & (F.col("term") <= last.term)))
        rest = rest.filter(~taken)
    return {r.term: r.action for r in most}, rest.select("term")


def find_disclosures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: DataFrame | None = None, with_text: bool = False) -> DataFrame:
    """One row per document: row, doc_id, spans of base kinds and of disclosing terms (``base``, ``added``), and its text if asked.

    A place that is both to be generalised and to be removed is removed.
    """
    spark = docs.sparkSession
    terms = stored(terms if terms is not None else disclosing_terms(docs, text_col), "pii-terms")
    listed, rest = _listed(terms if "docs" in terms.columns else terms.withColumn("docs", F.lit(0)))
    known = spark.sparkContext.broadcast((listed, Bloom.of(rest), Bloom.of(terms.filter("entity is not null").select(F.concat_ws(" ", "entity", "term")))))
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    marks = stored(slim.mapInArrow(_marked(known, with_text), f"row bigint, doc_id bigint, entity string, term string, spans array<{SPAN}>, added array<{SPAN}>, text string"), "pii-marks")
    none = F.lit(None).cast(f"array<{SPAN}>")
    named = F.transform("spans", lambda s: F.struct(F.col("action").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    wanted = terms.select(F.col("entity").alias("_e"), F.col("term").alias("_t"), "action")
    met = marks.filter("term is not null").join(wanted, (F.col("term") == F.col("_t")) & F.col("entity").eqNullSafe(F.col("_e")))
    added = met.select("row", "doc_id", none.alias("base"), named.alias("added"), "text")
    plain = marks.filter("term is null").select("row", "doc_id", F.col("spans").alias("base"), "added", "text")
    both = (plain if with_text else plain.drop("text")).unionByName(added if with_text else added.drop("text"))
    out = [F.max("doc_id").alias("doc_id"), F.flatten(F.collect_list("base")).alias("base"), F.array_distinct(F.flatten(F.collect_list("added"))).alias("added")]
    found = both.groupBy("row").agg(*out, *([F.max("text").alias("text")] if with_text else []))
    weaker = lambda s: (s["kind"] == "generalise") & F.array_contains(F.transform(F.filter("added", lambda x: x["kind"] == "remove"), lambda x: x["start"]), s["start"])
    return found.withColumn("added", F.when(F.size("added") > 0, F.filter("added", lambda s: ~weaker(s))).otherwise(F.col("added")))


def sanitised(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with base spans generalised to their kind, disclosing terms generalised or removed."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        out.append(text[at:a])
        if a >= at and kind != "remove":
            out.append("[TERM]" if kind == "generalise" else f"[{kind.upper()}]")
        at = b
    return "".join([*out, text[at:]])


@F.pandas_udf(T.StringType())
def _sanitised(text, spans):
    import pandas as pd

    return pd.Series([sanitised(t, [(x["kind"], x["start"], x["end"]) for x in s]) for t, s in zip(text, spans)], dtype=object)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the sanitised text, one row per document."""
    found = find_disclosures(docs, id_col, text_col, with_text=True)
    return found.select("doc_id", _sanitised("text", F.concat("base", "added")).alias("text"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_disclosures(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined_spans(F.col("base"), BASE_KINDS), 256).alias("base_sha256"),
        joined_spans(F.concat("base", "added"), KINDS).alias("spans"),
    )
