import re

from hypothesis import given, settings
from hypothesis import strategies as st

from paceline.llm import secrets as S


def plain(text, rules):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text, r.flags):
            if m.end(r.group) - m.start(r.group) >= r.at_least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_queries_of_patterns():
    assert S.trigram_query("[0-9a-f]{24,}") is None
    assert S.trigram_query("abcd") == ("and", (b"abc", b"bcd"))
    assert S.trigram_query("abc|xyz") == ("or", (b"abc", b"xyz"))
    assert S.trigram_query("(abc)?d*") is None
    assert S.trigram_query("abc(?:x|yz)") is not None
    assert S.trigram_query("AbC", re.I) is None  # letters beyond ASCII might match


def test_whole_table_against_plain_scan(documents):
    rows = {r.doc_id: r for r in S.digest(documents).collect()}
    for r in documents.collect():
        got = rows[r.doc_id]
        want = S.base_oracle(r.text)
        assert got.base_sha256 == S.base_sha(r.text)
        assert (got.n_assign, got.n_access, got.n_hex) == tuple(sum(k == x for _, k, _ in want) for x in ("assign", "access", "hex"))
        assert got.spans == ",".join(f"{S.RULES[k].kind}:{s}:{e}" for s, k, e in plain(r.text, S.RULES))


def test_odd_rows(odd, spark):
    rows = S.digest(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[9].spans.startswith("assign:0:20,") and by[9].n_access == 1 and by[9].n_hex == 1 and by[2].spans == ""
    assert S.digest(odd.limit(0)).collect() == []
    clean = S.redact(odd)
    assert clean.columns == odd.columns
    texts = {r.doc_id: r for r in clean.collect()}
    assert texts[9].text == '[SECRET]" [SECRET] [SECRET]' and texts[9].n_chars == 27 and texts[2].text is None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["password", "PASSWD", "api_key", "=", ": ", '"', "abcdef", "AKIA", "ABCDEFGH0123", "0123456789abcdef", "é", " ", "\n", "eyJ", "ghp_", "a" * 40, ".", "-----BEGIN RSA PRIVATE KEY-----"]), max_size=14), st.integers(1, 4))
def test_index_loses_nothing(parts, n):
    texts = ["".join(parts[i::n]) for i in range(n)]
    got = S._scanner(S.RULES).spans([t.encode() for t in texts])
    assert got == [plain(t, S.RULES) for t in texts]
