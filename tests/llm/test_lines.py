import random

import numpy as np
import xxhash

from granary.llm import lines

PASSAGE = " ".join(f"shared{i}" for i in range(60))
SCHEMA = "doc_id long, text string, removed_lines string"


def run(spark, rows, use=lines.Settings()):
    frame = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    return {r["doc_id"]: r for r in lines.dedup_lines(frame, use).collect()}


def brute_force(rows, use):
    """What stays of every text: a chunk goes if its bytes occur at an earlier place."""
    first, cut = {}, {}
    for doc_id, text in sorted((r for r in rows if r[1]), key=lambda r: r[0]):
        own = text.encode().split(b"\n")
        for a, b in sorted(lines.spans(own, use)):
            body = b"\n".join(own[a:b])
            if first.setdefault(body, (doc_id, a)) != (doc_id, a):
                cut.setdefault(doc_id, set()).update(range(a, b))
    return {i: t if i not in cut else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut[i]) for i, t in rows}


def test_equals_brute_force(spark):
    rng = random.Random(4)
    blocks = ["\n".join(" ".join(f"b{b}w{rng.randrange(99)}" for _ in range(rng.randrange(1, 25))) for _ in range(12)) for b in range(6)]
    rows = []
    for i in range(60):
        own = [" ".join(f"d{i}w{rng.randrange(9999)}" for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 8))]
        own.insert(rng.randrange(len(own) + 1), rng.choice(blocks))
        rows.append((i, "\n".join(own)))
    found = run(spark, rows)
    assert {i: r["text"] for i, r in found.items()} == brute_force(rows, lines.Settings())
    assert sum(r["removed_lines"] > 0 for r in found.values()) > 30


def test_long_passage_stays_once(spark):
    rows = [(i, f"own {i}\n{PASSAGE}\nend {i}") for i in range(5)] + [(9, PASSAGE + " not quite"), (10, "clean text")]
    found = run(spark, rows)
    assert [PASSAGE in found[i]["text"].split("\n") for i in range(5)] == [True] + [False] * 4
    assert found[3]["text"] == "own 3\nend 3" and found[3]["removed_lines"] == 1
    assert found[9]["text"] == rows[5][1] and found[10]["text"] == "clean text"


def test_boundaries_survive_an_insertion():
    own = [f"line {i}".encode() for i in range(200)]
    moved = own[:50] + [b"new"] + own[50:]
    a, b = lines.boundaries(lines.line_hashes(own)), lines.boundaries(lines.line_hashes(moved))
    assert (np.delete(b, [50, 51]) == np.delete(a, [50])).all()


def test_a_full_sieve_changes_nothing(spark):
    rows = [(1, PASSAGE), (2, PASSAGE.replace("shared7", "other7"))]
    found = run(spark, rows, lines.Settings(sieve_bits=64))
    assert [found[i]["text"] for i in (1, 2)] == [t for _, t in rows]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, PASSAGE), (3, PASSAGE), (4, PASSAGE), (None, PASSAGE), (5, f"{PASSAGE}\n\n{PASSAGE}"), (6, "x\n" * 30_000)]
    frame = spark.createDataFrame([(i, t, None) for i, t in rows], SCHEMA)
    found = sorted(((r["doc_id"] or 99, r["text"]) for r in lines.dedup_lines(frame).collect()), key=str)
    assert found == sorted([(1, None), (2, ""), (3, PASSAGE), (3, PASSAGE), (4, ""), (99, ""), (5, ""), (6, "x\n" * 30_000)], key=str)
    assert lines.dedup_lines(frame.limit(0)).count() == 0


def test_passage_of_short_lines_goes_whatever_surrounds_it(spark):
    passage = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(5)] + ["and a short end"]
    rng = random.Random(7)
    own = lambda i: [" ".join(f"d{i}w{rng.randrange(9999)}" for _ in range(rng.randrange(1, 20))) for _ in range(rng.randrange(1, 9))]
    around = {i: (own(i), own(i)) for i in range(40)}
    found = run(spark, [(i, "\n".join(a + passage + b)) for i, (a, b) in around.items()])
    assert found[0]["removed_lines"] == 0
    assert all(found[i]["text"] == "\n".join(a + b) for i, (a, b) in around.items() if i)


def test_short_lines_repeated_inside_one_text(spark):
    passage = "\n".join(" ".join(f"p{k}w{i}" for i in range(12)) for k in range(5))
    found = run(spark, [(1, f"{passage}\nbetween\n{passage}"), (2, "y\n" * 300), (3, "y\n" * 70 + "end")])
    assert found[1]["text"] == f"{passage}\nbetween"
    assert found[2]["removed_lines"] == 0 and found[3]["text"] == "end"


def own_chunks(lines, least):
    """Without the operator's help: the shortest chunks from and up to each line with a word, and all lines between boundaries."""
    words = [len(x.split()) for x in lines]
    found = set()
    for a in range(len(lines)):
        for b in range(a + 1, len(lines) + 1):
            if words[a] and sum(words[a:b]) >= least:
                found.add((a, b))
                break
        for b in range(a, -1, -1):
            if words[a] and sum(words[b : a + 1]) >= least:
                found.add((b, a + 1))
                break
    strong = lines_module_strength(lines)
    for level in range(4):
        edges = [0, *(i + 1 for i in range(len(lines) - 1) if strong[i] >= level), len(lines)]
        for a, b in zip(edges, edges[1:]):
            if sum(words[a:b]) >= least and (level or b - a == 1):
                found.add((a, b))
    return found


def lines_module_strength(own):
    """Zero bits at the end of the rolling hash, by the method's definition in plain numbers."""
    full, last, found = 1 << 64, 0, []
    for x in own:
        h = xxhash.xxh64_intdigest(x)
        v = (last * 0x9E3779B97F4A7C15 + h) % full
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            v = (v ^ v >> 33) * factor % full
        v ^= v >> 33
        found.append((v & -v).bit_length() - 1 if v else 64)
        last = h
    return found


def test_chunks_equal_a_plain_search():
    rng = random.Random(12)
    for n in (1, 2, 30, 120):
        own = [" ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice([0, 0, 1, 5, 12, 60]))).encode() for _ in range(n)]
        assert set(lines.spans(own, lines.Settings())) == own_chunks(own, 50)


def test_memory_follows_the_text():
    import tracemalloc

    blank = b"\n" * 100_000 + b" ".join(b"w%d" % i for i in range(60))
    single = b"\n".join(b"word%d" % i for i in range(200_000))
    for text, chunks in ((blank, 1), (single, 200_000 - 49)):
        tracemalloc.start()
        found = lines.chunks_of(text, lines.Settings())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found.hashes) >= chunks and peak < 100_000_000


def test_a_short_text_costs_few_calls():
    """The time of a text with a few lines is that of the calls made for it; small arrays took 334."""
    import cProfile
    import pstats

    rng = random.Random(5)
    text = "\n".join(" ".join(rng.choices("abcdefgh", k=40)) for _ in range(9)).encode()
    assert len(lines.chunks_of(text, lines.Settings()).hashes) > 9
    profile = cProfile.Profile()
    profile.runcall(lines.chunks_of, text, lines.Settings())
    assert pstats.Stats(profile).total_calls < 250
