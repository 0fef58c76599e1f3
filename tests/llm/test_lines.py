"""Line dedup: the guarantee for repeated runs, clean documents, odd rows, and a plain version."""

from __future__ import annotations

import random

from millrace.llm.lines import dedup_lines


def line(rnd, n):
    return " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))


def docs_of(rows):
    """Documents in order, one per id and text, as lists of (line number, words) without blank lines."""
    docs = sorted({(d is None, d or 0, text or "") for d, text, _ in rows})
    return [((None if none else d), [(k, tuple(x.split())) for k, x in enumerate(text.split("\n")) if x.split()]) for none, d, text in docs]


def runs_before(docs, n):
    """Whether a run of lines of document n stands whole at an earlier place."""
    lines = docs[n][1]

    def stands(a, b):
        run = [w for _, w in lines[a : b + 1]]
        for m in range(n + 1):
            other = [w for _, w in docs[m][1]]
            for q in range(len(other) - len(run) + 1):
                if (m, q) < (n, a) and other[q : q + len(run)] == run:
                    return True
        return False

    return stands


def check_deletions(rows, got, least=25):
    """Nothing goes that is not whole at an earlier place, and repeated runs of twice the words go."""
    docs = docs_of(rows)
    for n, (d, lines) in enumerate(docs):
        place, stands = {k: i for i, (k, _) in enumerate(lines)}, runs_before(docs, n)
        gone = set()
        for low, high in got[d]["ranges"]:
            a, b = place[low], place[high]
            assert sum(len(w) for _, w in lines[a : b + 1]) >= least and stands(a, b)
            gone.update(range(a, b + 1))
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                long = sum(len(w) for _, w in lines[a : b + 1]) >= 2 * least
                if long and sum(len(w) for _, w in lines[a:b]) < 2 * least and stands(a, b):
                    assert any(k in gone for k in range(a, b + 1))


def test_plain_version_and_guarantee(documents):
    rnd = random.Random(4)
    shared = [[line(rnd, rnd.choice([2, 9, 14, 30])) for _ in range(9)] for _ in range(4)]
    rows = []
    for k in range(60):
        body = [line(rnd, rnd.choice([1, 5, 12, 40])) for _ in range(6)]
        block = rnd.choice(shared)
        a = rnd.randrange(5)
        body[3:3] = block[a:a + rnd.randint(2, 6)] + [""]
        rows.append((k, "\n".join(body), "s"))
    got = {r["doc_id"]: r for r in dedup_lines(documents(rows)).collect()}
    check_deletions(rows, got)
    # A run of 50 words or more seen before is gone, and unrelated lines stay.
    first = {}
    for d, text, _ in rows:
        gone = {k for x in got[d]["ranges"] for k in range(x["low"], x["high"] + 1)}
        for k, x in enumerate(text.split("\n")):
            if len(x.split()) >= 25 and x in first:
                assert k in gone
            if x.split() and x not in first:
                assert k not in gone
        for x in text.split("\n"):
            first.setdefault(x, d)


def test_parts_from_different_places_do_not_add_up(documents):
    """A F, F B and A F B: the last is in no other document, so nothing goes."""
    rnd, rows = random.Random(9), []
    for k in range(60):
        a, f, b = line(rnd, 8), line(rnd, 10), line(rnd, 8)
        rows += [(3 * k, f"{a}\n{f}", "s"), (3 * k + 1, f"{f}\n{b}", "s"), (3 * k + 2, f"{a}\n{f}\n{b}", "s")]
    got = {r["doc_id"]: r for r in dedup_lines(documents(rows)).collect()}
    assert not any(r["ranges"] for r in got.values())
    check_deletions(rows, got)


def test_random_shared_runs(documents):
    rnd = random.Random(12)
    pool, rows = [line(rnd, rnd.choice([3, 8, 12, 30])) for _ in range(14)], []
    for k in range(50):
        a = rnd.randrange(10)
        rows.append((k, "\n".join(pool[a : a + rnd.randint(1, 5)] + [line(rnd, 6)] + pool[rnd.randrange(14):][:3]), "s"))
    got = {r["doc_id"]: r for r in dedup_lines(documents(rows).withColumnRenamed("lang", "d").withColumnRenamed("source", "v")).collect()}
    check_deletions(rows, got)


def test_odd_rows(documents):
    long = " ".join(f"p{k}" for k in range(60))
    rows = [(1, long + "\nown one", "s"), (2, "x\n\n" + long + "\ny", "s"), (3, None, "s"), (4, "", "s"), (5, "short", "s"), (6, "short", "s"),
            (7, long + "\n" + long, "s"), (8, "same " * 30, "s"), (8, "same " * 30, "s"), (None, long, "s")]
    docs = documents(rows).withColumnRenamed("lang", "ranges").withColumnRenamed("n_chars", "run")
    got = sorted(((r["doc_id"] or 99, r["kept"]) for r in dedup_lines(docs).collect()), key=repr)
    assert got == sorted([(1, long + "\nown one"), (2, "x\n\ny"), (3, None), (4, ""), (5, "short"), (6, "short"), (7, ""),
                          (8, "same " * 30), (8, "same " * 30), (99, "")], key=repr)
    assert dedup_lines(documents([])).collect() == []
