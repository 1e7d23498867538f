import random

from samples import awkward, table, vocabulary

from tidemark.llm.line_dedup import remove_boilerplate


def test_against_brute_force(spark):
    r = random.Random(3)
    vocab = vocabulary(60)
    sources = [f"s{i}" for i in range(30)] + [None]
    lines = [" ".join(r.choice(vocab) for _ in range(4)) for _ in range(120)]
    rows = []
    for i in range(500):
        own = [r.choice(lines[: r.choice([5, 30, 120])]) for _ in range(r.randint(0, 6))] + [f"line {i}", "", "  "]
        s = r.randrange(31)
        rows.append((i, "\n".join(own), sources[min(s, r.choice([4, 5, 30]))]))
    rows += [(x[0], x[1], "s1") for x in awkward()]
    for sites in (1, 5, 12):
        where = {}
        for _, text, source in rows:
            for line in (text or "").split("\n"):
                if line.strip(" "):
                    where.setdefault(line, set()).add(source)
        wanted = []
        for i, text, _ in rows:
            all_lines = (text or "").split("\n")
            kept = [x for x in all_lines if len(where.get(x, ())) < sites]
            wanted.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
        got = remove_boilerplate(table(spark, rows), sites).collect()
        assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_empty(spark):
    assert remove_boilerplate(table(spark, [(1, "a")]).where("false")).collect() == []
