"""Secret scans with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived (AND over the parts that every match must
contain, OR over their alternatives). Documents are indexed segment by segment (neighbours in a batch, 1 MB of text or one longer text): a posting
list for each trigram that some rule asks for. A rule's query intersects and unites postings; only the documents that
remain are verified with the regular expression. Rules without a mandatory trigram scan every document of the segment.
Segments are independent, so nothing is shuffled, memory is bounded by a segment, and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import by_bytes, claim, id_and_text


@dataclass(frozen=True)
class Rule:
    """group and at_least: the group (0: the match) that must have so many characters, else the match is dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    at_least: int = 0


# The three base rules.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),  # a run of 20 or more: the same matches as AKIA[A-Z0-9]+ of 20 or more
    Rule("hex", r"[0-9a-f]{24,}"),  # likewise, as a greedy match takes a whole run
)
# Published formats of credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

#: A query: None (every document), a trigram, or ("and" | "or", parts).
Query = None | bytes | tuple

SEGMENT = 1 << 20  # bytes of text that are indexed together
_WIDEST = 64  # alternatives that are followed side by side


def _of_string(s: bytes) -> Query:
    grams = sorted({s[i : i + 3] for i in range(len(s) - 2)})
    return _all(grams)


def _all(parts) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts) -> Query:
    parts = list(dict.fromkeys(parts))
    return None if not parts or None in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _characters(items) -> set[bytes] | None:
    """The strings that a character class stands for, in lower case; None if they are many."""
    found: set[bytes] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            found.add(chr(arg).encode("utf-8", "surrogatepass").lower())
        elif op is sre.RANGE and arg[1] - arg[0] < 16:
            found |= {chr(c).encode("utf-8", "surrogatepass").lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= 16 else None


def _finite(op, arg) -> set[bytes] | None:
    """All strings that a node can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg).encode("utf-8", "surrogatepass").lower()}
    if op is sre.IN:
        return _characters(arg)
    if op is sre.SUBPATTERN:
        return _finite_sequence(arg[3])
    if op is sre.BRANCH:
        options = [_finite_sequence(x) for x in arg[1]]
        return None if any(x is None for x in options) else set().union(*options)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 4:
        one = _finite_sequence(arg[2])
        return None if one is None else set().union(*(_finite_power(one, n) for n in range(arg[0], arg[1] + 1)))
    return None


def _finite_power(one: set[bytes], n: int) -> set[bytes]:
    out = {b""}
    for _ in range(n):
        out = {a + b for a in out for b in one}
    return out


def _finite_sequence(nodes) -> set[bytes] | None:
    out = {b""}
    for op, arg in nodes:
        if (x := _finite(op, arg)) is None or len(out) * len(x) > _WIDEST:
            return None
        out = {a + b for a in out for b in x}
    return out


def _of_sequence(nodes) -> Query:
    parts, run = [], {b""}

    def close(after: set[bytes]) -> set[bytes]:
        parts.append(_any([_of_string(s) for s in sorted(run)]))
        return after

    for op, arg in nodes:
        strings = _finite(op, arg)
        if strings is not None and len(run) * len(strings) <= _WIDEST:
            run = {a + b for a in run for b in strings}
            continue
        run = close({b""} if strings is None or len(strings) > _WIDEST else strings)
        if strings is None and op is sre.SUBPATTERN:
            parts.append(_of_sequence(arg[3]))
        elif strings is None and op is sre.BRANCH:
            parts.append(_any([_of_sequence(x) for x in arg[1]]))
        elif strings is None and op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0]:
            parts.append(_of_sequence(arg[2]))
    close(run)
    return _all(parts)


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """The Boolean trigram query that every text with a match satisfies; trigrams are of UTF-8 with A-Z in lower case.

    With re.IGNORECASE the pattern must also be re.ASCII, else letters beyond ASCII could match ASCII ones: such a
    pattern, as one without mandatory trigrams, gives None (scan fully)."""
    if flags & re.IGNORECASE and not flags & re.ASCII or re.search(r"\(\?[aiLmsux]", pattern):
        return None
    return _of_sequence(sre_parser.parse(pattern, flags))


def _trigrams(query: Query) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(_trigrams(q) for q in query[1]))


class Scanner:
    """Compiled rules with their queries; the code table maps a trigram to its number."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.compiled = [re.compile(r.pattern, r.flags) for r in rules]
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        self.grams = sorted(set().union(*(_trigrams(q) for q in self.queries)))
        self.number = {g: i for i, g in enumerate(self.grams)}
        self.codes = np.zeros(1 << 24, dtype=np.uint16)
        for g, i in self.number.items():
            self.codes[int.from_bytes(g, "big")] = i + 1

    def postings(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each trigram of the queries the documents of this segment that hold it, ascending."""
        ends = np.cumsum([len(t) for t in texts])
        found: list[list[np.ndarray]] = [[] for _ in self.grams]
        data = np.frombuffer(b"".join(texts).lower(), dtype=np.uint8)
        step = 1 << 18
        for lo in range(0, max(0, len(data) - 2), step):
            part = data[lo : lo + step + 2].astype(np.uint32)
            hit = self.codes[(part[:-2] << 16) | (part[1:-1] << 8) | part[2:]]
            at = np.flatnonzero(hit)
            which, place = hit[at].astype(np.int64) - 1, at + lo
            doc = np.searchsorted(ends, place, side="right")
            inside = place + 2 < ends[doc]
            keys = np.unique(which[inside] * len(texts) + doc[inside])
            for g in np.unique(keys // len(texts)):
                found[g].append(keys[keys // len(texts) == g] % len(texts))
        return [np.unique(np.concatenate(x)) if x else np.zeros(0, dtype=np.int64) for x in found]

    def candidates(self, query: Query, postings: list[np.ndarray], n: int) -> np.ndarray:
        if query is None:
            return np.arange(n)
        if isinstance(query, bytes):
            return postings[self.number[query]]
        parts = sorted((self.candidates(q, postings, n) for q in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True)
        return out

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """(start, number of the rule, end) in code points, sorted, for each text."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        decoded: dict[int, str] = {}
        postings = self.postings(texts)
        for k, (rule, compiled) in enumerate(zip(self.rules, self.compiled, strict=True)):
            for d in self.candidates(self.queries[k], postings, len(texts)).tolist():
                text = decoded.get(d)
                if text is None:
                    text = texts[d].decode("utf-8", "replace")
                    if self.queries[k] is not None:
                        decoded[d] = text
                for m in compiled.finditer(text):
                    if m.end(rule.group) - m.start(rule.group) >= rule.at_least:
                        out[d].append((m.start(), k, m.end()))
        for x in out:
            x.sort()
        return out


_scanners: dict[tuple[Rule, ...], Scanner] = {}


def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    claim("secrets", _scanners.clear)
    if rules not in _scanners:
        _scanners[rules] = Scanner(rules)
    return _scanners[rules]


def _segments(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are indexed together: SEGMENT bytes, or one text that is longer."""
    return by_bytes([n or 0 for n in pc.binary_length(texts).to_pylist()], SEGMENT)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each row of docs: doc_id, spans array<struct<kind,start,end>> by start, then rule order.

    Null and empty texts have no spans; repeated rows give repeated results; an empty table an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for lo, hi in _segments(texts):
                found = scanner.spans([x or b"" for x in texts.slice(lo, hi - lo).to_pylist()])
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array([[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in x] for x in found], kind)], ["doc_id", "spans"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digest(docs: DataFrame, rules: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """Spans of the base rules and of `rules`, counted and digested for each document."""
    found = scan(docs, BASE_RULES + rules)
    base = [r.kind for r in BASE_RULES]

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in base), F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """docs with each secret (overlapping ones as one) replaced by `mark`; n_chars follows the text. No row goes."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        scanner, parts, whole = _scanner(rules), [], texts.cast(pa.binary())
        for lo, hi in _segments(whole):
            out = whole.slice(lo, hi - lo).to_pylist()
            changed = False
            for i, spans in enumerate(scanner.spans([x or b"" for x in out])):
                if spans:
                    text, kept, at, changed = out[i].decode(), [], 0, True
                    for start, _, end in spans:
                        if start >= at:
                            kept += [text[at:start], mark]
                        at = max(at, end)
                    out[i] = ("".join(kept) + text[at:]).encode()
            parts.append(pa.array(out, pa.binary()) if changed else whole.slice(lo, hi - lo))
        return pa.concat_arrays(parts).cast(pa.string()) if parts else texts

    out = docs.withColumn("text", clean(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def base_oracle(text: str) -> list[tuple[int, str, int]]:
    """The three base rules, written plainly, for tests."""
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), "assign", m.end()))
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda x: (x[0], order.index(x[1])))


def base_sha(text: str) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in base_oracle(text)).encode()).hexdigest()
