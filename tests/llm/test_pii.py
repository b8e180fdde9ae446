import math
import random
import re
from collections import Counter, defaultdict

from deltafolio.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def plain(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return out


def check(docs, texts):
    rows = pii.scan(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for k, text in texts:
        base, r = plain(text), by_id[k]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x[0] == kind for x in base) for kind in range(4)]
        assert r["base_spans"] == pii.joined(base)
        assert set(filter(None, r["base_spans"].split(","))) <= set(filter(None, r["spans"].split(",")))
    return by_id


def test_base_spans_like_plain_patterns(documents, odd_docs, odd_texts, no_docs):
    check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()])
    check(odd_docs, odd_texts)
    assert pii.scan(no_docs).collect() == []


def test_random_strings_like_plain_patterns():
    r = random.Random(11)
    for alphabet in ("a@.b-", "12.3 ", "4 -59", "+1 (2).9-x", "a1@.+ (-)"):
        for _ in range(3000):
            text = "".join(r.choice(alphabet) for _ in range(r.randint(1, 40)))
            assert pii.base_spans(text) == plain(text), text
    assert pii.base_spans("0000255.1.2.3 256.1.1.1 1.2.3.4.5.6.7.8") == plain("0000255.1.2.3 256.1.1.1 1.2.3.4.5.6.7.8")


def test_contexts_discover_unseen_identifiers(spark):
    seeds = [(k, f"please call our office number +1 (21{k}) 555-010{k} today thanks") for k in range(10)]
    unseen = [(20, "please call our office number 0049-30-1234567 today thanks"), (21, "lot 123456789012 was sold")]
    docs = spark.createDataFrame(seeds + unseen, "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in pii.scan(docs, min_confidence=0.85).collect()}
    assert rows[20]["spans"] == "phone:30:45" and rows[20]["base_spans"] == "" and rows[20]["n_discovered"] == 1
    assert rows[21]["spans"] == ""


EDGE = ".,;:!?\"'()[]{}<>|*#$%&"


def plain_mentions(text):
    """(kind, start, end, instance, patterns), by splitting the text into words."""
    base, words = plain(text), [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    meets = lambda s, e: any(x < e and s < y for _, x, y in base)
    marked = [bool(re.search("[0-9@]", text[s:e])) and not meets(s, e) for s, e in words]
    runs = []
    for k, (s, e) in enumerate(words):
        if not marked[k]:
            continue
        if k and marked[k - 1] and text[words[k - 1][1] : s] in (" ", "\t", "\xa0") and text[words[k - 1][1] - 1] not in ".,;:!?":
            runs[-1][1] = e
        else:
            runs.append([s, e])
    found = list(base)
    for s, e in runs:
        while s < e and text[s] in EDGE and not (text[s] == "(" and ")" in text[s:e].rstrip(EDGE) and text[s + 1] not in EDGE):
            s += 1
        while e > s and text[e - 1] in EDGE:
            e -= 1
        if re.search("[0-9@]", text[s:e]):
            found.append((-1, s, e))
    clean = lambda w: w.lower().strip(EDGE)
    out = []
    for kind, s, e in found:
        before, after = [clean(w) for w in text[:s].split()[-2:]], [clean(w) for w in text[e:].split()[:1]]
        # A word that the mention begins or ends inside counts with its part outside.
        far, near = ["", "", *before][-2:]
        out.append((kind, s, e, " ".join(text[s:e].lower().split()), (f"{far} {near} _".strip(), f"{near} _ {after[0] if after else ''}")))
    return out


def plain_scan(texts, min_support=3, min_confidence=0.9):
    """doc_id -> all spans; the graph in plain dictionaries."""
    edges, where = defaultdict(lambda: -1), defaultdict(list)
    for k, text in texts:
        for kind, s, e, instance, patterns in plain_mentions(text or ""):
            for p in patterns:
                edges[p, instance] = max(edges[p, instance], kind)
            if kind < 0:
                where[instance].append((k, s, e))
    accepted = {}
    while True:
        counts = defaultdict(Counter)
        for (p, i), kind in edges.items():
            counts[p][kind if kind >= 0 else accepted.get(i, -1)] += 1
        weight = defaultdict(Counter)
        for p, c in counts.items():
            total = sum(c.values())
            best = max(((n, -k) for k, n in c.items() if k >= 0), default=None)
            if best and best[0] >= min_support and best[0] >= min_confidence / 2 * total:
                for q, i in edges:
                    if q == p and edges[q, i] < 0 and i not in accepted:
                        weight[i][-best[1]] += math.log(1 - best[0] / (total + 1))
        new = {}
        for i, kinds in weight.items():
            kind = min(kinds, key=lambda k: (round(kinds[k], 9), k))
            if 1 - math.exp(kinds[kind]) >= min_confidence:
                new[i] = kind
        if not new:
            break
        accepted |= new
    spans = {k: {(kind, s, e) for kind, s, e in plain(text)} for k, text in texts}
    for i, kind in accepted.items():
        for k, s, e in where[i]:
            spans[k].add((kind, s, e))
    return {k: pii.joined(sorted(v)) for k, v in spans.items()}


def test_discovery_like_a_plain_graph(spark, documents):
    r = random.Random(17)
    contexts = [("please call", "today"), ("write to", "soon"), ("the card", "was"), ("account number is", "thanks"), ("lot", "sold"), ("x", "y")]
    make = [lambda: f"+1 (21{r.randrange(10)}) 555-0{r.randrange(100, 999)}", lambda: f"u{r.randrange(40)}@ex.org", lambda: f"020 7946 {r.randrange(30):04d}", lambda: f"AB{r.randrange(20)}", lambda: f"({r.randrange(200, 215)}) 555-1234", lambda: str(r.randrange(50))]
    texts = []
    for k in range(400):
        parts = []
        for _ in range(r.randrange(4)):
            c = r.randrange(6)
            before, after = contexts[c]
            parts.append(f"{before} {make[c if r.random() < 0.5 and c < 2 else r.randrange(6)]()} {after}")
        texts.append((k, r.choice(("\n", ". ", " ", ", ")).join(parts)))
    found = {x["doc_id"]: x["spans"] for x in pii.scan(spark.createDataFrame(texts, "doc_id bigint, text string"), min_support=2, min_confidence=0.6).collect()}
    wanted = plain_scan(texts, 2, 0.6)
    assert found == wanted
    assert sum(w.count(",") for w in wanted.values()) > 20 and wanted != {k: pii.joined(plain(t)) for k, t in texts}
    rows = [(x["doc_id"], x["text"]) for x in documents.collect()]
    assert {x["doc_id"]: x["spans"] for x in pii.scan(documents).collect()} == plain_scan(rows)


def test_mentions_like_splitting_into_words(odd_texts):
    r = random.Random(23)
    texts = ["".join(r.choice(["12", "ab", " ", " ", "(", ")", "@", "\n", ". ", ", ", "7-7", "\t", "x9"]) for _ in range(r.randrange(30))) for _ in range(3000)]
    for text in texts + [t or "" for _, t in odd_texts]:
        assert [(*m[:4], (m[4], m[5])) for m in pii.mentions(text, pii.base_spans(text))] == plain_mentions(text), text


def test_discovery_goes_on_until_it_settles(spark):
    """Each context leads to the next identifiers only: three hops."""
    rows = [(k, f"alpha beta +1 (212) 555-01{k:02d} gamma") for k in range(81)]
    chain, many = ["alpha beta {} gamma", "delta eps {} zeta", "eta theta {} iota", "kappa lam {} mu"], [27, 9, 3]
    for hop, n in enumerate(many):
        for k in range(n):
            rows.append((100 + 100 * hop + k, chain[hop].format(f"H{hop}N{k}")))
            rows.append((1000 + 100 * hop + k, chain[hop + 1].format(f"H{hop}N{k}")))
    found = {r["doc_id"]: r["n_discovered"] for r in pii.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(found[k] == 1 for k, _ in rows if k >= 100)


def test_long_mentions_and_contexts_are_not_cut(spark):
    near = "w" * 500
    rows = [(k, f"{near} call +1 (212) 555-01{k:02d} now") for k in range(15)] + [(50, f"{near} call {'7x' * 300} now"), (51, f"{near}w call {'8x' * 300} then")]
    found = {r["doc_id"]: r["spans"] for r in pii.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[50] == "phone:506:1106" and found[51] == ""


def test_redaction_masks_every_span(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, "mail a.b@c.de or 10.0.0.1", 25, "x"), (2, None, None, "y"), (2, "+1 (974) 555-3436 or 4111 1111 1111 1111", 0, "z")], "doc_id bigint, text string, n_chars bigint, kept string")
    rows = sorted(pii.redact(docs, length_col="n_chars").collect(), key=lambda r: r["kept"])
    assert [tuple(r) for r in rows] == [(1, "mail <EMAIL> or <IP>", 20, "x"), (2, None, None, "y"), (2, "<PHONE> or <CARD>", 17, "z")]
    assert pii.redact(odd_docs).columns == odd_docs.columns and pii.redact(odd_docs).count() == odd_docs.count()
    assert pii.redact(no_docs).collect() == []
