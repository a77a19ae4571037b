"""Quality counts and verdicts against plain versions."""

import random
import re
from collections import Counter, defaultdict

from plumbline.llm import quality


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    full = [x for x in lines if re.search(r"[^\x20\x09-\x0D]", x)]
    for x in full:
        dup += x in seen
        seen.add(x)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), len(full),
        sum("A" <= c <= "Z" for c in text),
    )


def bucket(v):
    s = max(v.bit_length() - 5, 0) if v else 0
    return v >> s << s


def verdicts(rows):
    """`(doc_id, kept)` by sorting all values."""
    made, groups = [], {level: defaultdict(list) for level in range(3)}
    for doc_id, text, lang, source in rows:
        c = dict(zip(quality.COUNTS, counts(text)))
        shares = {k: 1000 * c[a] // max(c[b], 1) for k, (a, b, _) in quality.SHARES.items()}
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        made.append((doc_id, lang, source, shares, failed))
        if not failed:
            for level, key in enumerate(((lang, source), lang, None)):
                groups[level][key].append(shares)
    out = []
    for doc_id, lang, source, shares, failed in made:
        kept = not failed
        if kept:
            whole, own, narrow = (groups[level][key] for level, key in ((2, None), (1, lang), (0, (lang, source))))
            for k, (_, _, tail) in quality.SHARES.items():

                def cut(members):
                    values = sorted(bucket(m[k]) for m in members)
                    mid, high = (values[-(-q * len(values) // 100) - 1] for q in (50, tail))
                    return high + (high - mid) // 2 + quality.TIE_GUARD

                limit = cut(whole)
                for members in (own, narrow):
                    if len(members) >= quality.MIN_DOCUMENTS:
                        limit = min(cut(members), quality.LIFT * limit)
                kept &= shares[k] <= limit
        out.append((doc_id, kept))
    return out


def corpus():
    rnd = random.Random(3)
    rows = []
    for i in range(700):
        words = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 7))) for _ in range(rnd.randint(20, 200))]
        kind = rnd.random()
        if kind < 0.1:
            words = [w.upper() + "!!" for w in words]
        elif kind < 0.2:
            words = [w + rnd.choice(["###", "|", "%%"]) for w in words]
        elif kind < 0.3:
            words = words[:8] * 30
        text = " ".join(words).replace(" a ", "\n")
        if kind > 0.9:
            text = "\n".join([text.split("\n")[0]] * 4) + "\n \n" + text
        rows.append((i, text, rnd.choice(["en", "en", "de", None]), rnd.choice(["big", "big", "big", "small", None])))
    return rows + [(None, None, None, None), (9001, "", "en", "big"), (9002, "x " * 5000, "fr", "new"), rows[3], rows[3]]


def test_counts_and_verdicts(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_words int, kept string")
    got = quality.quality(df).collect()
    want = [(r[0], *counts(r[1])[:5], k) for r, (_, k) in zip(rows, verdicts(rows))]
    assert sorted(((r.doc_id, *(r[c] for c in quality.COUNTS[:5]), r.kept) for r in got), key=str) == sorted(want, key=str)
    assert 300 < sum(r.kept for r in got) < 650
    kept = quality.good_documents(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (tuple(r)[:4] for r in kept.collect()))) == sorted(str(r) for r, (_, k) in zip(rows, verdicts(rows)) if k)
    assert quality.quality(df.limit(0)).count() == 0 and quality.good_documents(df.limit(0)).count() == 0


def clean(rnd, n):
    """Sentences of different words, on lines of their own."""
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(n)]
    lines = [" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12)]
    return "\n".join(lines)


OUTLIERS = {
    "symbols": lambda rnd, text: text.replace(" ", "## ", 40),
    "capitals": lambda rnd, text: text.upper(),
    "dup_lines": lambda rnd, text: "\n".join([*text.split("\n"), *["one two three."] * 8]),
    "repeats": lambda rnd, text: text + " " + " ".join(["four five six seven eight nine ten."] * 4),
}


def kept_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return {r.doc_id: r for r in quality.quality(df).collect()}


def test_each_rule_rejects_a_planted_outlier(spark):
    rnd = random.Random(9)
    rows = [(i, clean(rnd, rnd.randint(120, 300)), rnd.choice(["en", "de"]), "s") for i in range(900)]
    planted = {1000 + i: (name, make) for i, (name, make) in enumerate(OUTLIERS.items())}
    rows += [(i, make(rnd, clean(rnd, 240)), "en", "s") for i, (_, make) in planted.items()]
    got = kept_of(spark, rows)
    assert sum(not got[i].kept for i in range(900)) <= 9
    for i, (name, _) in planted.items():
        assert not got[i].kept and not got[i].base_failed, name
        clean_values = {k: max(got[n][f"s_{k}"] for n in range(900)) for k in quality.SHARES}
        assert got[i][f"s_{name}"] > clean_values[name]


def test_a_source_full_of_spam_does_not_lift_its_cutoff(spark):
    rnd = random.Random(10)
    rows = [(i, clean(rnd, rnd.randint(120, 300)), "en", rnd.choice("abc")) for i in range(1500)]
    for i in range(2000, 2400):
        text = clean(rnd, rnd.randint(120, 300))
        rows.append((i, OUTLIERS["symbols"](rnd, text) if i % 10 < 3 else text, "en", "spammy"))
    got = kept_of(spark, rows)
    assert not any(got[i].kept for i in range(2000, 2400) if i % 10 < 3)
    assert sum(not got[i].kept for i in got if i < 2000 or i % 10 >= 3) <= 30


def test_cutoffs_follow_the_group(spark):
    """A source of another kind keeps its own measure, up to twice its language's."""
    rnd = random.Random(11)
    rows = [(i, clean(rnd, 200), "en", "plain") for i in range(600)]
    titled = lambda: " ".join(w.capitalize() if rnd.random() < 0.15 else w for w in clean(rnd, 200).split(" "))
    rows += [(i, titled(), "en", "titled") for i in range(1000, 1300)]
    rows += [(2000, titled(), "en", "plain")]
    got = kept_of(spark, rows)
    assert not got[2000].kept
    assert sum(got[i].kept for i in range(1000, 1300)) > 280


def test_kept_documents_are_counted_once(spark):
    """The Python function stands in the plan once, so a task needs one Python worker."""
    rows = [(i, clean(random.Random(i), 60), "en", "s") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    plan = quality.good_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
