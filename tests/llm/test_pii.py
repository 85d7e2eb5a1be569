import hashlib
import math
import random
import re
from collections import defaultdict

from hunch.llm import pii as P

from . import util as U

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(d):
    return sum(x - 9 * (x > 9) for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def good(kind, v):
    d = re.sub("[^0-9]", "", v)
    return [True, kind == 1 and all(int(p) <= 255 for p in v.split(".")), 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15][kind]


def base(t):
    return [(m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, t) if good(k, m[0])]


def mentions(t):
    at = r" ?[(\[][aA][tT][)\]] ?"
    rx = re.compile(rf"[A-Za-z0-9._%+-]+(?:@|{at})[A-Za-z0-9.-]+|[+(]?[0-9](?:[ ().-]{{0,2}}[0-9]){{5,}}")
    out, last = [], 0
    ms = [m for m in _scan(rx, t)]
    for i, (s, e) in enumerate(ms):
        after = t[e:ms[i + 1][0] if i + 1 < len(ms) else len(t)][:24]
        gap, v = t[last:s][-48:], t[s:e]
        last = e
        if e - s > P.MAX_CHARS or re.match("[A-Za-z0-9]", after):
            continue
        handle = bool(re.search(f"@|{at}", v))
        kind = 5 if handle else 4
        value = re.sub(at, "@", v).lower() if handle else re.sub("[^0-9]", "", v)
        known = any(re.fullmatch(PATTERNS[k], v) and good(k, v) for k in ([0] if handle else [1, 2, 3]))
        left, right = re.findall(r"[^\W_]+", gap.lower()), re.findall(r"[^\W_]+", after.lower())
        pats = [(kind, "b", *left[-2:])] if len(left) > 1 else []
        pats += [(kind, "a", left[-1], right[0])] if left and right else []
        out.append((s, kind, e, (kind, value), known, pats))
    return out


def _scan(rx, t):
    at, end = 0, 0
    while at <= len(t):
        if at == end or not re.match(r"[A-Za-z0-9._%+-]", t[at - 1]):
            m = rx.match(t, at)
            if m and m.end() > at:
                yield at, m.end()
                at = end = m.end()
                continue
        at += 1


def brute(texts):
    texts = [(i, t or "") for i, t in texts if i is not None]
    found = {t: mentions(t) for _, t in texts}
    edges = defaultdict(dict)
    for ms in found.values():
        for *_, value, known, pats in ms:
            for p in pats:
                edges[p][value] = edges[p].get(value, False) or known
    accepted = set()
    while True:
        conf = {}
        for p, vs in edges.items():
            k0, k = sum(vs.values()), sum(x or v in accepted for v, x in vs.items())
            if k0 and k >= P.MIN_SUPPORT and k / (len(vs) + 1) >= P.MIN_CONF:
                conf[p] = k / (len(vs) + 1)
        doubt = defaultdict(float)
        for p, c in conf.items():
            for v, x in edges[p].items():
                if not x:
                    doubt[v] += math.log(1 - c)
        now = {v for v, x in doubt.items() if round(1 - math.exp(x), 9) >= P.ACCEPT}
        if now == accepted:
            break
        accepted = now
    out = []
    for i, t in texts:
        b = sorted(base(t))
        more = [(s, k, e) for s, k, e, v, known, pats in found[t] if not known and v in accepted and any(p in conf for p in pats)]
        join = lambda x: ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in sorted(x))
        out.append((i, *[sum(x[1] == k for x in b) for k in range(4)], hashlib.sha256(join(b).encode()).hexdigest(), join(b + more)))
    return sorted(out)


def found(spark, texts):
    return sorted(tuple(r) for r in P.find_pii(U.docs(spark, texts)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans").collect())


def test_base_spans_match_brute_force(spark):
    r = random.Random(11)
    parts = ["a.b+c@d-e.fg.h", "x@y", "x@y.z@w.v", "_q@r.s", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "00001.2.3.000255", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111",
             "+1 (739) 555-5817", "+49 30 1234567 ", "+1", "+12-", "é", "ö@é.com", "𝒳", " ", "-", ".", "@", "+", "9", "12 ", "aa", "%", "user (at) mail.org", "me[AT]host", "123456", "(0) 44 12 34 56", "\n"]
    t = [(i, "".join(r.choice(parts) for _ in range(r.randrange(1, 14)))) for i in range(1500)] + U.odd_texts()
    t += [(5000, "a" * 20_000), (5001, "a@b" + ".c" * 30_000), (5002, "1" * 20_000), (5003, "1 " * 50_000 + "x"), (5004, "+1" + " (" * 50_000), (5005, "a@b.c " * 3000 + "1.2.3.4 " * 3000), (5006, "1." * 50_000)]
    t += [(6000, "first a@b.cd"), (6000, "second +12 345 678 90 1"), (6000, "first a@b.cd")]
    assert found(spark, t) == brute(t)
    assert found(spark, []) == []


def test_contexts_discover_identifiers(spark):
    r = random.Random(4)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    t = [(i, f"{U.words(5, i)} call me at +1 {number(3)} {number(7)} today or write to u{i}@mail.org please") for i in range(20)]
    t += [(100, "then call me at 0739 555 5817 today again"), (101, "or write to jane (at) mail.org please"), (102, "build 20261203 is out, order 445566778 shipped")]
    t += [(103, "now dial him 0739 555 5817 twice")] + [(110 + i, f"now dial him +44 {number(10)} twice") for i in range(3)]  # the value is known by now, its pattern is not
    got = {x[0]: x[-1] for x in found(spark, t)}
    assert got[100] == "number:16:29" and got[101] == "handle:12:30" and got[102] == ""
    assert found(spark, t) == brute(t)
    twice = t + t[:10]
    assert found(spark, twice) == brute(twice)
