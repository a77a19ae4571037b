"""Personal data against a plain scan, labelers, models and all."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import regex

from plumbline.llm import personal as p

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_of(text):
    return [(k, m.start(), m.end()) for k in p.BASE for m in re.finditer(PLAIN[k], text) if passes(k, m[0])]


def has(pattern, text):
    return regex.search(pattern, text) is not None


def account_holds(text):
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def votes_of(kind, text, before, after):
    formed = account_holds(text) if kind == "iban" else kind != "name" and has(p.VALID[kind], text)
    words, plain = text.split(" "), text.replace(" ", "")
    known = {
        "name": any(w in p.GIVEN for w in words),
        "spoken_email": re.search("[A-Za-z0-9-]+$", text)[0] in p.DOMAINS if kind == "spoken_email" else False,
        "iban": p.COUNTRIES.get(text[:2]) == len(plain),
    }
    malformed = len(words) > 4 or len(set(words)) < len(words) if kind == "name" else not formed
    cue = has(p.CUES[kind], before) or kind == "name" and has(p.TITLE, text)
    said = {
        "formed": formed,
        "malformed": malformed,
        "known": known.get(kind, False),
        "thing": kind == "name" and any(w in p.THINGS for w in words),
        "cue": cue,
        "counter": has(p.COUNTER, before),
        "contact": has(p.CONTACT, before) or has(p.CONTACT, after),
        "part": has(p.PART_BEFORE, before) or has(p.PART_AFTER, after),
    }
    shape = {
        "short": len(text) <= 10,
        "long": len(text) > 24,
        "line_start": has(r"(?:^|\n)[\x20\t]*$", before),
        "stopped": has(r"^(?:$|[,;)\n])", after),
        "introduced": has(r"[:(<]\x20?$", before),
    }
    return [kind == k for k in p.ADDED] + [said[v] for v in p.VOTES] + [shape[s] for s in p.SHAPES]


def candidates_of(text):
    found = [(m.start(), m.end(), m[0]) for m in regex.finditer(p.ANY, text)]
    for n, (start, end, own) in enumerate(found):
        left = found[n - 1][1] if n else 0
        right = found[n + 1][0] if n + 1 < len(found) else len(text)
        kind = next(k for k, told in p.TOLD.items() if has(told, own))
        yield kind, start, end, votes_of(kind, own, text[max(left, start - p.BEFORE) : start], text[end : min(right, end + p.AFTER)])


def fitted(features):
    """Likelihoods by expectation-maximisation, then the classifier's weights, one candidate a row."""
    x = np.array(features, float).reshape(-1, len(p.FEATURES))
    kinds, fired = x[:, : len(p.ADDED)].argmax(axis=1), x[:, len(p.ADDED) : len(p.ADDED) + len(p.VOTES)]
    r = np.zeros(len(x))
    masses = {}
    for k in sorted(set(kinds)):
        f, share = fired[kinds == k], p.PRIOR_SHARE
        rates = [p.PRIOR_RATES[d] for d in p.VOTES.values()]
        for _ in range(p.ROUNDS + 1):
            z = math.log(share / (1 - share)) + sum(np.where(f[:, j] == 1, math.log(a / b), math.log((1 - a) / (1 - b))) for j, (a, b) in enumerate(rates))
            own = 1 / (1 + np.exp(-z))
            share = min(0.95, (own.sum() + p.PRIOR_SHARE * p.PRIOR_SHARE_ROWS) / (len(f) + p.PRIOR_SHARE_ROWS))
            rates = [
                p._directed(
                    v,
                    ((own * f[:, j]).sum() + p.PRIOR_RATES[d][0] * p.PRIOR_ROWS) / (own.sum() + p.PRIOR_ROWS),
                    (((1 - own) * f[:, j]).sum() + p.PRIOR_RATES[d][1] * p.PRIOR_ROWS) / ((1 - own).sum() + p.PRIOR_ROWS),
                )
                for j, (v, d) in enumerate(p.VOTES.items())
            ]
        r[kinds == k] = own
        masses[k] = own.sum(), (1 - own).sum()
    pull = np.array([0.5 / (len(masses) * max(masses[k][0], 1e-9)) for k in kinds]) * r
    push = np.array([0.5 / (len(masses) * max(masses[k][1], 1e-9)) for k in kinds]) * (1 - r)
    weights = ahead = np.zeros(len(p.FEATURES))
    for step in range(p.STEPS):
        error = (pull + push) / (1 + np.exp(-x @ ahead)) - pull
        moved = ahead - p.STEP * (error @ x + p.SHRINK * ahead)
        ahead = moved + step / (step + 3) * (moved - weights)
        weights = moved
    weights = weights.copy()
    for k, (own, other) in masses.items():
        weights[k] += math.log(own) - math.log(other)
    return weights, x @ weights


def expected(texts):
    found = [[*candidates_of(t)] for t in texts]
    flat = [c for cs in found for c in cs]
    _, scores = fitted([c[3] for c in flat])
    supported = [any(c[3][len(p.ADDED) + j] for j, d in enumerate(p.VOTES.values()) if d > 0) for c in flat]
    assert np.abs(scores).min() > 1e-6
    keep = iter([s >= 0 and v for s, v in zip(scores, supported)])
    out = []
    for text, cs in zip(texts, found):
        base = base_of(text)
        kept = [c[:3] for c in cs if next(keep)]
        added = [c for k in p.ADDED for c in kept if c[0] == k]
        show = lambda xs: ",".join(f"{k}:{s}:{e}" for k, s, e in xs)
        counts = [sum(k == b[0] for b in base) for k in p.BASE]
        out.append((*counts, hashlib.sha256(show(base).encode()).hexdigest(), show(base + added)))
    return out


PIECES = [
    "bob@example.com", "a@b.c_d@e.f", "x@y", "a.b+c@d-e.f.g.", "@@", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "0000255.1.1.1", "4381893557741609",
    "4381 8935 5774 1609", "4381-8935-5774-1608", "12345678901234567890", "+1 (152) 555-8590", "+49 30 1234567", "+1 2", "+++123456789012345678",
    "(212) 555-1234", "212-555-1234", "012-055-1234", "Tel: ", "phone ", "call ", "123-45-6789", "000-12-3456", "SSN ", "DE89 3704 0044 0532 0130 00",
    "DE89370400440532013001", "IBAN ", "account: ", "John Smith", "Maria Garcia Lopez", "Apache License", "Public License", "Sich Sich Sich", "Red House",
    "Dr Jane Doe", "name: ", "signed ", "And The Of A Bee Cee", "bob at example dot com", "bob [at] example.org", "look at this dot product", "mail ",
    "version ", "order #", "prose of words", "É", "😀", "\n", ", ", ": ", "(", ")", "x", "-", "/", "Ünsal Özil", "1",
]
SCHEMA = "doc_id long, text string, kind string, votes int, spans string"
NAMES = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def test_against_plain_scan(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(PIECES) + rnd.choice(["", " ", " ", " "]) for _ in range(rnd.randint(1, 12))) for _ in range(1200)]
    texts += ["", "7" * 50_000 + " 1.2.3.4", "x" * 50_000 + " bob@example.com", "a@b" + ".c" * 20_000, "And " * 3000, "1.2.3.4 " * 2500, "Anna Red " * 300]
    rows = [(n, t, "x", 1, "y") for n, t in enumerate(texts)] + [(None, texts[5], "x", 1, "y"), (None, None, None, None, None)] + [(7, texts[7], "y", 2, "z")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["doc_id"], *[r[c] for c in NAMES]) for r in p.scan(df).collect()), key=str)
    want = sorted(((r[0], *e) for r, e in zip(rows, expected([r[1] or "" for r in rows]))), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w
    for kind in p.ADDED:
        assert sum(f"{kind}:" in w[-1] for w in want) > 10
    assert not any("name" in w[-1] for w in want if w[0] is not None and w[0] < 1200 and "John" not in texts[w[0]] and "Maria" not in texts[w[0]] and not re.search("Jane|name|signed|Dr", texts[w[0]]) and not has(p.CONTACT, texts[w[0]]))


def test_clean_texts_and_nothing(spark):
    clean = ["The quick brown fox. Then Another Day came", "Apache License Version 2", "see section 212-555-1234", "And And And", "Sur Le Pont"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(clean * 50)], "doc_id long, text string")
    assert {r["spans"] for r in p.scan(df).collect()} == {""}
    assert p.scan(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "bob@example.com John Smith")], "doc_id long, text string")
    plan = p.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("text, holds", [("DE89 3704 0044 0532 0130 00", True), ("GB82WEST12345698765432", True), ("GB82WEST12345698765433", False)])
def test_account_checks(spark, text, holds):
    from pyspark.sql import functions as F

    assert spark.range(1).select(p.account_checks(F.lit(text))).first()[0] is holds is account_holds(text)
