"""Alignment, url rules and divergence beside brute force, over odd rows and empty tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from daystrata.llm import alignment, divergence, url_filter

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "\n\n", "a", "two  spaces\tand\ttabs ", "don't we'll!!! $5.00", "<|endoftext|> inside </s> <s>", "日本語 ﬁ é 😀 x", "has ▁ mark", "nul \0 here",
    "one two three.\nfour five", "one two three.\nfour five", "word " * 9000, "\nstart", "end\n", "Ünïcödé wörds nbsp", "antidisestablishmentarianism 12345678",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeated rows and ids, very long texts, columns named like results."""
    rows = [(i, t, "en" if i % 2 else None, ("s", "t", None)[i % 3], "x", 1, 2) for i, t in enumerate(ODD)]
    rows += [(3, ODD[5], None, None, None, None, None), (None, ODD[11], "en", "s", None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, pairs string, n_best int, value int")


def plain_alignment(texts):
    """Groups, links and counts of whole texts, straight from the libraries and the byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_library, b_library = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_library.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    value = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    done = []
    for text in texts:
        a = a_library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_library.encode(text or "")
        bytes_a = [bytes(value[c] for c in a_library.id_to_token(k)) for k in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b_library.is_byte(k) else p.replace("▁", " ").encode() for k in b for p in [b_library.id_to_piece(k)]]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            done.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        common, links, groups = sorted(set(ends_a) & set(ends_b)), [], []
        low = 0
        for high in common:
            groups.append(",".join(str(k) for k, e in zip(a, ends_a) if low < e <= high) + "|" + ",".join(str(k) for k, e in zip(b, ends_b) if low < e <= high))
            low = high
        p = q = 0
        while p < len(a):
            links.append((a[p], b[q]))
            step = min(ends_a[p], ends_b[q])
            p, q = p + (ends_a[p] == step), q + (ends_b[q] == step)
        done.append((len(a), len(b), groups, links))
    docs = Counter(pair for x in done if x for pair in set(x[3]))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else (
        x[0], x[1], len(x[2]), len(x[3]), sum(docs[p] == best[p[0]] for p in x[3]), sum(docs[p] for p in x[3]),
        hashlib.sha256(";".join(x[2]).encode()).hexdigest()) for x in done]


@pytest.mark.parametrize("sent", [alignment.SENT_PAIRS, 7])
def test_alignment_by_brute_force(spark, odd, sent):
    random.seed(3)
    letters = " \n  \t'abcdeéñß019.,;!?$<>()\"-▁日ﬁ\U0001f600"
    texts = [r["text"] for r in odd.collect()] + ["".join(random.choice(letters) for _ in range(random.randint(0, 80))) for _ in range(80)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r[0]: tuple(r[1:]) for r in alignment.digests(rows, BYTES, PIECES, sent).collect()}
    for i, expected in enumerate(plain_alignment([t if t is None or len(t) < 20000 else None for t in texts])):
        if texts[i] is None or len(texts[i]) < 20000:
            assert found[i][:4] == expected[:4] and found[i][6] == expected[6], texts[i]


def test_alignment_counts_by_brute_force(spark, odd):
    texts = [t for t in ODD if t is None or len(t) < 20000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for sent in (alignment.SENT_PAIRS, 7):
        found = {r[0]: tuple(r[1:]) for r in alignment.digests(rows, BYTES, PIECES, sent).collect()}
        assert [found[i] for i in range(len(texts))] == plain_alignment(texts)
    assert alignment.digests(odd, BYTES, PIECES).count() == odd.count() and alignment.digests(odd.limit(0), BYTES, PIECES).count() == 0
    whole = {r["doc_id"]: r for r in alignment.aligned(rows, BYTES, PIECES).collect()}
    assert whole[4]["groups"] == plain_groups("a") and whole[0]["groups"] == ""


def plain_groups(text):
    pair = alignment.TokenPair(BYTES, PIECES)
    (ids,) = pair.encode([text])
    return ";".join(pair.align(*ids)[0])


def test_stretches_equal_common_ends():
    random.seed(1)
    for _ in range(300):
        total = random.randint(1, 120)
        a, b = (np.array(sorted({total, *random.sample(range(1, total + 1), random.randint(0, total))})) for _ in "ab")
        if random.random() < 0.3:
            b = a.copy()
        groups = []
        for i, j, m, n, paired in alignment.stretches(a, b):
            groups += [(i + k + 1, j + k + 1) for k in range(m)] if paired else [(i + m, j + n)]
            assert not paired or m == n
        ends = sorted(set(a.tolist()) & set(b.tolist()))
        assert groups == [(int(np.searchsorted(a, e)) + 1, int(np.searchsorted(b, e)) + 1) for e in ends]
        at_a, at_b = alignment.link_places(a, b)
        assert len(at_a) == len(a) + len(b) - len(ends) == len(set(zip(at_a.tolist(), at_b.tolist())))


URLS = [
    None, "", "no scheme", "http://", "https://A.NET/x", "https://net/", "http://net", "https://x.example.net/en/1?y", "https://example.net/en", "https://EXAMPLE.NET/en/#a",
    "http://badexample.net/en/", "http://example.com/de/x", "http://b.example.com/de?x", "http://w.org/fr/1", "http://org/fr/", "http://w.org/en/", "http://a//://b.net/", "://net/",
    "http://x.net?q=/", "http://.net/", "http://net./", "http://ÉX.net/é", "http://a.b.c/" + "d" * 30000, "https://x.example.net/en/1?y",
]


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_url_rules_by_brute_force(spark):
    four = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    random.seed(7)
    many = [(random.choice(["a.net", "b.net", "net", "x.y.org", "y.org", "org", ""]), random.choice(["", "/", "/a", "/a/b", "/c/"]), random.choice(["allow", "block"])) for _ in range(40)]
    urls = URLS + [f"http://{random.choice(['a.net', 'q.a.net', 'b.net', 'x.y.org', 'z.x.y.org', 'com'])}{random.choice(['', '/', '/a', '/a/b/c', '/c/d'])}?q" for _ in range(200)]
    df = spark.createDataFrame([(None if i == 5 else i, u, "h", "v") for i, u in enumerate(urls)], "page_id bigint, url string, host string, verdict string")
    for rules, part in ((four, url_filter.PART_KEYS), (many, url_filter.PART_KEYS), (many, 5), ([], 5)):
        found = Counter(tuple(r) for r in url_filter.judge(df, spark.createDataFrame(rules, url_filter.RULES), part).collect())
        assert found == Counter((None if i == 5 else i, *plain_verdict(u, rules)) for i, u in enumerate(urls))
    assert url_filter.judge(df.limit(0), spark.createDataFrame(four, url_filter.RULES)).count() == 0


def test_cascade_tells_listed_keys_exactly(spark, monkeypatch):
    # Filters this small let many keys pass by chance, so several levels are needed.
    monkeypatch.setattr(url_filter, "LEAST_BITS", 64)
    hosts = [f"h{k}.net" for k in range(300)]
    parts = spark.createDataFrame([(h, "/") for h in hosts], "host string, path string")
    listed = spark.createDataFrame([(h + "/",) for h in hosts[::3]], "key string")
    made = url_filter.cascade(listed, parts, 12, [1])
    assert len(made.filters) > 3
    keys = [h + "/" for h in hosts] + ["net/"]
    assert made.listed(keys).tolist() == [k % 3 == 0 and k < 300 for k in range(len(keys))]


def plain_audit(rows, least, top):
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", word.findall((text or "").translate(lower))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for g, _, words in docs if g == lang for t in set(words))
        kept = {t for t, n in held.items() if n >= least}
        counts = {s: Counter() for g, s, _ in docs if g == lang}
        for g, s, words in docs:
            if g == lang:
                counts[s].update(w for w in words if w in kept)
        whole = sum(counts.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept)) for t in kept} for s, c in counts.items()}
        q = {t: 1 + 10**9 * (whole[t] + 1) // (whole.total() + len(kept)) for t in kept}
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            found = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", found, top)):
                order = sorted(items, key=lambda x: (x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, -value, rank + 1) for rank, (value, item) in enumerate(order)]
    return Counter(out)


def test_divergence_by_brute_force(spark, odd, monkeypatch):
    random.seed(2)
    words = ["alpha", "Beta", "GAMMA", "delta's", "é", "日本", "ﬁn", "x1y", "É", "z"]
    rows = [(random.choice(["en", "de", None, ""]), random.choice(["s1", "s2", "S2", "é", None, "one"]), " ".join(random.choices(words, k=random.randint(0, 30)))) for _ in range(150)]
    rows += [("fr", "only", "few words"), ("fr", "other", None), ("it", "alone", "x x x")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, source string, text string, value int, part string")
    for entries in (divergence.PART_ENTRIES, 3):
        monkeypatch.setattr(divergence, "PART_ENTRIES", entries)
        assert Counter(tuple(r) for r in divergence.audit(df, top=4).collect()) == plain_audit(rows, 3, 4)
    monkeypatch.setattr(divergence, "HELD", 2)
    rows = [(r["lang"], r["source"], r["text"]) for r in odd.collect()]
    assert Counter(tuple(r) for r in divergence.audit(odd).collect()) == plain_audit(rows, 3, 200)
    assert divergence.audit(odd.limit(0)).count() == 0


def test_columns_intersect_runs():
    rng = np.random.default_rng(4)
    counts, times = rng.integers(0, 3, (40, 3)), rng.integers(1, 5, 40)
    rows, sources = np.nonzero(counts)
    columns = divergence.Columns(rows, sources + 1, counts[rows, sources], times, 3)
    for s in range(3):
        for t in range(3):
            of_s, of_t, length = columns.pair(s, t)
            got = Counter()
            for a, b, n in zip(of_s.tolist(), of_t.tolist(), length.tolist()):
                got[a, b] += n
            expected = Counter()
            for (a, b), n in zip(counts[:, [s, t]].tolist(), times.tolist()):
                expected[a, b] += n
            assert got == expected
