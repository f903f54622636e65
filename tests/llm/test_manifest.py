import hashlib
import random
import zlib

from granary.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, digest string, leaf string, path string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def tower(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        low = at // 8 * 8
        yield level[low:at], level[at + 1 : low + 8]
        at //= 8


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for group in groups.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    towers = [tower([leaf(r, r[4]) for r in groups[g]]) for g in order]
    top = tower([t[-1][0] for t in towers])
    answer = []
    for place, (g, levels) in enumerate(zip(order, towers)):
        for at, row in enumerate(groups[g]):
            path = [*siblings(levels, at), *siblings(top, place)]
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            now = leaf(row, text)
            for before, after in path:
                now = sha(*before, now, *after)
            root = top[-1][0]
            answer.append((row[0], leaf(row, row[4]), levels[-1][0], root, sha(*[d for b, a in path for d in (*b, *a)]), now, now == root))
    return sorted(answer, key=repr)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], SCHEMA)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in manifest.audit_documents(frame, manifest.tampered_text()).select(names).collect()), key=repr)


def test_equals_brute_force(spark):
    """Group sizes around powers of eight, one group with most rows."""
    rng = random.Random(5)
    sizes = {"a": 1, "b": 7, "c": 8, "d": 9, "e": 64, "f": 65, None: 17, "": 3, "é": 2, "zz": 600}
    rows, number = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            number += rng.randrange(1, 5)
            rows.append((number, rng.choice(["web", "book", None]), lang, rng.choice([None, 3]), rng.choice(["Some Text", "low", "", None, "Ünïcode É"])))
    rng.shuffle(rows)
    found = run(spark, rows)
    assert found == brute_force(rows)
    assert {r[-1] for r in found} == {True, False}


def test_one_row_is_its_own_root(spark):
    found = run(spark, [(1, "s", "en", 1, "x")])
    own = leaf((1, "s", "en", 1), "x")
    assert found == [(1, own, own, own, sha(), own, True)] == brute_force([(1, "s", "en", 1, "x")])


def test_repeated_rows_and_null_ids(spark):
    """A third of all rows is one row."""
    rows = [(7, "s", "en", 1, "Same")] * 40 + [(i, "s", "en", 1, f"T{i}") for i in range(70)] + [(None, None, None, None, None)] * 3 + [(None, "s", "en", 1, "x"), (7, "s", "en", 2, "Other")]
    assert run(spark, rows) == brute_force(rows)


def test_long_text_and_empty_table(spark):
    rows = [(1, "s", "en", 1, "Word " * 400_000), (3, "s", "en", 1, "é" * 1000)]
    assert run(spark, rows) == brute_force(rows)
    assert run(spark, []) == []


def test_own_claims_and_columns(spark):
    """The general form: other groups, digests and columns."""
    rows = [("x", i, sha(str(i)), sha("not it") if i == 3 else None, i * 10) for i in range(20)]
    frame = spark.createDataFrame(rows, "g string, order long, digest string, claimed string, size long")
    found = {r["size"]: r["verified"] for r in manifest.audited(frame).collect()}
    assert found == {i * 10: i != 3 for i in range(20)}
