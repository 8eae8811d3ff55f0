from collections import Counter, defaultdict
import re

from helixframe.llm import boilerplate, rules

EDGES = [(None, "null id here\nshared line", "s1"), (1, None, "s1"), (2, "", None), (3, " \t\n\n", "s2"), (4, "shared line\nown words", None)]


def test_boilerplate_like_brute_force(docs_of):
    rows = list(EDGES)
    for i in range(10, 60):
        lines = [f"own {i}", "Every  SITE has it" if i % 2 else "every site has it", f"half {i % 3}"]
        rows.append((i, "\n".join(lines), f"s{i % 12}"))
    rows.append(rows[-1])  # a repeated row
    sites, first = defaultdict(set), {}
    norm = lambda x: re.sub(r"[\x20\x09-\x0d]+", " ", x.lower()).strip(" ")
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            if norm(line):
                sites[norm(line)].add(s)
                order = (i is None, i)
                first[norm(line)] = min(first.get(norm(line), order), order)
    want = Counter()
    for i, t, s in rows:
        if t is None:
            want[(i, None, 0, 0)] += 1
            continue
        lines = t.split("\n")
        stay = [x for x in lines if not (norm(x) and len(sites[norm(x)]) >= 4 and first[norm(x)] != (i is None, i))]
        want[(i, "\n".join(stay), len(lines), len(lines) - len(stay))] += 1
    got = boilerplate.clean(docs_of(rows), min_sites=4).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert Counter(tuple(r) for r in got) == want
    assert "every site has it" in next(t for i, t, _, _ in want if i == 10)  # kept once


def test_boilerplate_empty_table(docs_of, spark):
    assert boilerplate.clean(docs_of([])).count() == 0


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_rules_like_brute_force(docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    rows = EDGES + [(10, long, "a"), (11, "a b c " * 40, "a"), (12, long + "\nboiler\n" + "x y\nx y", "a"), (13, "ü#*$ |<>&  x", "a")]
    rows += [(20 + i, f"doc {i}\nboiler one\n" + " ".join(f"v{i}_{k}" for k in range(60)), "host") for i in range(6)]
    rows += [(40 + i, " ".join(f"b{k}" for k in range(55)) + f"\nonly {i}", "host") for i in range(6)]
    rows += [(60, long, "copies")] * 8  # copies count as one document
    got = rules.judge(docs_of(rows), max_docs=5).collect()
    assert len(got) == len(rows)
    want = Counter((i, *base(t)) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert all(by[20 + i]["kept"] and by[20 + i]["left_words"] == 62 for i in range(6))
    assert all(not by[40 + i]["base_failed"] and not by[40 + i]["kept"] for i in range(6))  # depleted
    assert by[60]["kept"] and by[10]["kept"] and by[11]["base_failed"] and not by[1]["kept"]


def test_rules_run_no_python(docs_of):
    plan = rules.judge(docs_of([(1, "a", "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
