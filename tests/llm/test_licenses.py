import random

from panelcast.llm.licenses import TEMPLATES, Scanner, candidate_blocks, scan_licenses, wording


def test_every_wording_is_found_in_prose_word_for_word():
    rng, scanner = random.Random(3), Scanner()
    for name, text in TEMPLATES:
        prose = " ".join(f"w{rng.randrange(99)}" for _ in range(200))
        for shaped in (text, text.upper(), text.replace(" ", "\n", 3), "  " + text.replace(" ", "  ")):
            (hit,) = scanner.scan(f"{prose}\n{shaped}\n{prose}")
            assert hit[0] == name and hit[4] == 0 and hit[5] == ""
            assert [w for w, _, _ in wording(f"{prose}\n{shaped}\n{prose}"[hit[1] : hit[2]])] == [w for w, _, _ in wording(text)]


def test_differences_are_exact_and_bounded():
    scanner = Scanner()
    _, mit = max((t for t in TEMPLATES if t[0] == "MIT"), key=lambda t: len(t[1]))
    words = mit.split(" ")
    words[10], words[20:21] = "anybody", []
    ((name, _, _, gain, n, differences),) = scanner.scan("x y z\n" + " ".join(words))
    assert name == "MIT" and n == 3 and "+anybody" in differences.split() and gain > 0.5
    assert scanner.scan("Licensed under the Apache License, Version 1.0.") == []
    assert scanner.scan("permission is hereby granted to nobody; this software has no warranty at all") == []


def test_several_in_one_block_in_order():
    text = "Released under the MIT License.\nLicensed under CC BY-SA 4.0. Licensed under the Apache License, Version 2.0."
    assert [h[0] for h in Scanner().scan(text)] == ["MIT", "CC-BY-SA-4.0", "Apache-2.0"]


def test_long_lines_are_cut_around_the_stem():
    long = "word " * 5_000
    text = long + TEMPLATES[2][1] + " " + long
    assert all(b - a < 3_000 for a, b in candidate_blocks(text))
    assert [h[0] for h in Scanner().scan(text)] == ["Apache-2.0"]
    assert candidate_blocks(long) == []


def test_long_lines_around_a_wording_do_not_hide_it():
    """A wording between lines of ordinary words, where a small dictionary makes the whole block no smaller."""
    rng, scanner = random.Random(6), Scanner()
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(400)]

    def line(size):
        return " ".join(words[int(400 * rng.random() ** 3)] for _ in range(size // 6))

    for size in (700, 1_000):
        for name, text in TEMPLATES:
            block = "\n".join([*(line(size) for _ in range(3)), text, *(line(size) for _ in range(3))])
            assert [(h[0], h[4]) for h in scanner.scan(block)] == [(name, 0)]


def test_over_a_table(spark, docs, no_docs, clashing):
    more = spark.createDataFrame([(500, "İstanbul " + TEMPLATES[0][1], "tr", "s", 1), (500, "İstanbul " + TEMPLATES[0][1], "tr", "s", 1)], docs.schema)
    found = scan_licenses(docs.union(more)).collect()
    assert [(r.doc_id, r.license) for r in found] == [(500, "MIT")] * 2
    assert found[0].start == len("İstanbul ") and scan_licenses(no_docs).count() == 0 and scan_licenses(clashing).count() == 0
