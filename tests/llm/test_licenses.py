"""License templates against a plain matcher that follows every way through the markup."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidelog.llm import licenses, queries

TABLES = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ALL = [*((m, p) for p, m in licenses.PHRASES.items()), *licenses.TEMPLATES]


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def parts(markup):
    """Nested lists: words, ("optional", parts), ("var", least, most)."""
    stack = [[]]
    for piece in re.split(r"(<<.*?>>)", markup):
        if piece == "<<beginOptional>>":
            stack.append([])
        elif piece == "<<endOptional>>":
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif piece.startswith("<<var"):
            stack[-1].append(("var", *map(int, re.search(r"words=(\d+)-(\d+)", piece).groups())))
        else:
            stack[-1] += plain_words(piece)
    return stack[0]


def ends(items, words, starts):
    for item in items:
        if isinstance(item, str):
            starts = {s + 1 for s in starts if s < len(words) and words[s] == item}
        elif item[0] == "optional":
            starts = starts | ends(item[1], words, starts)
        else:
            starts = {s + k for s in starts for k in range(item[1], item[2] + 1) if s + k <= len(words)}
    return starts


def all_places(templates, text):
    words, found = plain_words(text), []
    for number, (_, markup) in enumerate(templates):
        items = parts(markup)
        first = next(i for i in items if isinstance(i, str))
        found += [(number, s, max(e) - s) for s, w in enumerate(words) if w == first and (e := ends(items, words, {s}))]
    return sorted(found, key=lambda p: (p[1], p[0]))


def places(templates, text):
    return sorted(licenses.Scanner(templates).places(licenses.words_of(text)), key=lambda p: (p[1], p[0]))


def filled(items, rng):
    """A text that a template accepts."""
    out = []
    for item in items:
        if isinstance(item, str):
            out.append(item)
        elif item[0] == "optional":
            out += filled(item[1], rng) if rng.random() < 0.5 else []
        else:
            out += [rng.choice("pqr") for _ in range(rng.randrange(item[1], item[2] + 1))]
    return out


@pytest.mark.parametrize("seed", range(20))
def test_small_templates_equal_all_ways(seed):
    rng = random.Random(seed)

    def markup(depth=0):
        some = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.5 or depth > 2:
                some.append(rng.choice("abc"))
            elif kind < 0.8:
                some.append(f"<<beginOptional>> {markup(depth + 1)} <<endOptional>>")
            else:
                least = rng.randrange(3)
                some.append(f"<<var;name=x;words={least}-{least + rng.randrange(3)}>>")
        return " ".join(some)

    templates = [(f"t{k}", rng.choice("abc") + " " + markup()) for k in range(6)]
    for _ in range(40):
        text = " ".join(rng.choice("aaabbcd") for _ in range(rng.randrange(0, 30)))
        assert places(templates, text) == all_places(templates, text)


@pytest.mark.parametrize("number", range(len(ALL)))
def test_every_template_accepts_what_it_says(number):
    rng = random.Random(number)
    items = parts(ALL[number][1])
    for _ in range(10):
        body = filled(items, rng)
        found = places(ALL, " ".join(["before", *body, "after"]))
        assert (number, 1) in {(p[0], p[1]) for p in found}
        assert found == all_places(ALL, " ".join(["before", *body, "after"]))
        # mandatory wording must match exactly
        at = next(k for k in range(len(body)) if body[k] == next(i for i in items if isinstance(i, str)))
        body[at] += "x"
        assert (number, 1) not in {(p[0], p[1]) for p in places(ALL, " ".join(["before", *body, "after"]))}


def test_marks_and_capitals_do_not_count():
    assert [p[1:] for p in places(ALL[:3], "Released UNDER\nthe «MIT» License; under-the-mit\tlicense, under the mit licenses")] == [(5, 4)]
    assert [p[1:] for p in places(ALL[:3], "Released UNDER\nthe (MIT) License; under-the-mit\tlicense, under the mit licenses")] == [(1, 4), (5, 4)]
    assert [ALL[p[0]][0] for p in places(ALL, "This is under the GNU General Public License, version 3, or (at your option) any later version.")] == ["gpl-3"]


def test_faulty_templates():
    for markup in ("<<beginOptional>> a <<endOptional>> b", "a <<beginOptional>> b", "", "<<var;name=x;words=0-2>> a"):
        with pytest.raises(ValueError):
            licenses.Scanner([("x", markup)])


def expected(text):
    words, found = plain_words(text), all_places(ALL, text)
    base = [p for p in found if p[0] < 3]
    labels = lambda some: ",".join(sorted({ALL[p[0]][0] for p in some}))
    covered = len({k for _, s, n in found for k in range(s, s + n)})
    starts = [p[1] for p in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), labels(base), labels(found), covered / len(words) if found else 0.0)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    found = queries.license_scan(spark, TABLES).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == {r.doc_id: expected(r.text) for r in table}
    assert len(found) == len(table)
    assert {"mit", "apache-2", "cc-by-nc", "gpl-3"} <= {r.labels for r in found}


def test_odd_rows(spark):
    texts = [
        (1, None), (2, ""), (3, " \t\r\n"), (4, "CC-BY-NC"), (4, "CC-BY-NC"), (None, "under the mit license " * 3000), (5, "x" * 300_000), (6, "under the mit licensé"),
        (7, "permission is hereby granted " * 5000), (8, "\x00under\x1cthe\x7fmit license"),
    ]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("licenses", "places", "label", "found")})
    out = licenses.with_licenses(frame).collect()
    assert len(out) == len(texts)
    for row in out:
        assert [tuple(p) for p in row.licenses.places] == [(p[0], ALL[p[0]][0], *p[1:]) for p in all_places(ALL, row.text)]
        assert row.licenses.n_words == len(plain_words(row.text)) and 0 <= row.licenses.score <= 1
    assert licenses.with_licenses(frame.limit(0)).count() == 0
    own = licenses.with_licenses(frame, more={"x <<var;name=n;words=1-2>>": "own"}).where("doc_id = 5").first()
    assert own.licenses.places == []
