import random
import re

import pytest

from shelfwise.llm.line_dedup import dedup_lines
from tests.llm.helpers import documents, odd_documents, with_clashes


def line_set(line):
    return frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)


def brute(rows, similarity=80):
    """Texts after removal, by comparing every line with every earlier one."""
    lines = []
    for doc, (key, text) in enumerate(rows):
        for i, line in enumerate([] if text is None else text.split("\n")):
            lines.append((key is None, key or 0, i, doc, line_set(line)))
    lines.sort(key=lambda x: x[:4])
    gone, earlier = set(), []
    for _, _, i, doc, words in lines:
        if words:
            if any(100 * len(words & e) >= similarity * len(words | e) for e in earlier):
                gone.add((doc, i))
            earlier.append(words)
    out = []
    for doc, (key, text) in enumerate(rows):
        parts = [] if text is None else text.split("\n")
        kept = [p for i, p in enumerate(parts) if (doc, i) not in gone]
        removed = len(parts) - len(kept)
        out.append((key, text if not removed else "\n".join(kept), len(parts), removed))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["text"], r["lines"], r["removed_lines"]) for r in df.collect()), key=repr)


def corpus(seed, count=60):
    """Families of lines with words exchanged, put in and left out; short lines; blank ones."""
    rng = random.Random(seed)
    bases = [[f"b{k}w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 10, 25, 60, 150]))] for k in range(25)]
    texts = []
    for _ in range(count):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            words = list(rng.choice(bases))
            for _ in range(rng.randrange(max(2, len(words) // 5))):
                place = rng.randrange(len(words))
                words[place : place + rng.choice([0, 1, 1])] = [rng.choice(["the", "of", f"n{rng.randrange(99)}"])][: rng.choice([0, 1, 1])]
                words = words or ["the"]
            rng.shuffle(words)
            lines.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in words))
            if rng.random() < 0.1:
                lines.append(rng.choice(["", " \t", "the of", "of  THE"]))
        texts.append("\n".join(lines))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(dedup_lines(documents(spark, rows).repartition(5))) == brute(rows)


@pytest.mark.parametrize("similarity", [50, 67, 100])
def test_other_similarities(spark, similarity):
    rows = corpus(7, 30)
    assert found(dedup_lines(documents(spark, rows), similarity=similarity)) == brute(rows, similarity)


def test_blanks_of_all_kinds(spark):
    """Lines with single blanks only are parted by another way than the rest."""
    base = [f"w{i}" for i in range(10)]
    rows = [(i, blank.join(base) + f"{blank}own\n{blank}{blank}Ä{i}{blank} ") for i, blank in enumerate([" ", "\t", "\v", "\f", "\r", "  ", " \t"])]
    rows += [(9, "w0\u00a0" + " ".join(base[1:])), (10, " \n\t\n w1 \n\nw1")]
    assert found(dedup_lines(documents(spark, rows))) == brute(rows)


def test_a_large_family(spark):
    base = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(base[:15] + [f"u{i}"] + base[15:]) + "\ncommon closing line of all\nown " + str(i)) for i in range(150)]
    assert found(dedup_lines(documents(spark, rows))) == brute(rows)


def test_unrelated_long_lines_are_no_candidates(spark):
    """Long lines fill a bitmap; two of them with a rare word in common are told apart all the same."""
    from shelfwise.llm import line_dedup as L

    rng = random.Random(5)
    common = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join([f"rare{i // 2}", *rng.sample(common, 199)])) for i in range(40)]
    docs = documents(spark, rows)
    assert L._with_candidates(L._lines(docs, "doc_id", "text"), L._rarity(docs, "text"), 80).count() == 0
    # Near copies are found whether both lines have second bitmaps, one or none.
    sizes = (9, L.LONG - 1, L.LONG, L.LONG + 1, 200)
    pairs = [" ".join(common[: n - odd]) for n in sizes for odd in (0, 1)]
    docs = documents(spark, list(enumerate(pairs)))
    assert L._with_candidates(L._lines(docs, "doc_id", "text"), L._rarity(docs, "text"), 80).count() == len(set(pairs))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # Rows with the same key and text are one document, so that it loses nothing to itself.
    one = list(dict.fromkeys(rows))
    expected = {(k, t): e for (k, t), e in zip(sorted(one, key=repr), [], strict=False)}
    assert expected == {}
    wanted = sorted(brute(one) + [e for e in brute(one) if e[0] == 3], key=repr)
    df = dedup_lines(with_clashes(docs, "key", "print", "numbers", "n"))
    assert found(df) == wanted
    clashing = dedup_lines(with_clashes(documents(spark, rows[:3]), "lines", "removed_lines"))
    assert clashing.columns[-2:] == ["_lines", "_removed_lines"]


def test_empty_table(spark):
    assert dedup_lines(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = dedup_lines(documents(spark, [(0, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_plans_hold_no_tables(spark):
    """The two lookup tables are subqueries; as literals they made plans of millions of characters."""
    from shelfwise.llm import line_dedup as L

    docs = documents(spark, corpus(4, 20))
    rarity, lines = L._rarity(docs, "text"), L._lines(docs, "doc_id", "text")
    some = L._with_candidates(lines, rarity, 80)
    covered = L._covered(lines, some, rarity, 80)
    for df in (some, covered):
        plan = df._jdf.queryExecution().toString()
        assert len(plan) < 200_000
        # The classes stand where they are used, and go through no row of their own.
        optimised = df._jdf.queryExecution().optimizedPlan().toString()
        assert "AS classes" not in optimised and "scalar-subquery" in optimised
