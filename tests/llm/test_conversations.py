import hashlib
import random
import zlib
from functools import cache

from helixframe.llm import conversations, queries



def accepts(initials):
    rest = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def follows(last, c):
    return {None: "su", "s": "u", "u": "a", "a": "u"}[last].count(c) > 0


def cheapest(rows):
    """(cost, audit, repaired lines) by recursion over suffixes; rows are (role, text, must_go, extra)."""

    @cache
    def best(i, last, inserts):
        options = []
        if i == len(rows) and last in (None, "a"):
            options.append((0, "", ()))
        if inserts < 2:
            for role in ("user", "assistant"):
                if follows(last, role[0]):
                    cost, audit, lines = best(i, role[0], inserts + 1)
                    options.append((cost + 5, "I" + audit, (f"{role}:", *lines)))
        if i < len(rows):
            role, text, must_go, extra = rows[i]
            cost, audit, lines = best(i + 1, last, 0)
            options.append((cost + 2, "D" + audit, lines))
            if not must_go:
                c = role[:1]
                if c == "" or follows(last, c):
                    cost, audit, lines = best(i + 1, c or last, 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                for other in ("user", "assistant"):
                    if follows(last, other[0]):
                        cost, audit, lines = best(i + 1, other[0], 0)
                        options.append((cost + 1 + extra, "R" + audit, (f"{other}:{text}", *lines)))
        return min(options, key=lambda o: o[:2], default=(10**9, "~", ()))

    return best(0, None, 0)


def brute(table):
    out = {}
    for conv_id, turn, role, text in table:
        kept = out.setdefault(conv_id, [])
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if kind == 4:
            role = "user"
        kept += [(turn is not None, turn or 0, role, text)] * (2 if kind == 3 else 1)
    for conv_id, kept in out.items():
        kept.sort()
        turns = {t for known, t, _, _ in kept if known}
        seen, rows, counts = set(), [], [0, 0, 0]
        for _, _, role, text in kept:
            shown = text.strip(" \t\n\v\f\r")
            fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            rows.append((role, text, fault in (0, 1), 5 if fault == 2 else 0))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit, lines = cheapest(tuple(rows))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv_id] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def result(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


SCHEMA = "conv_id long, turn long, role string, text string, score double, audit string"


def test_equals_brute_force(spark):
    draw = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(draw.randrange(1, 14)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = draw.choice(["Yes.", "No!", "open", "", " \n", "one. two", None, f"text {turn}. "])
            rows.append((conv if conv < 149 else None, draw.choice([turn, turn + 3, None, 2]), role, text, 0.5, "x"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(conversations.repair(conversations.damage(df))) == brute([r[:4] for r in rows])


def test_state_carries_across_batches_and_spills(spark, monkeypatch):
    rows = [(1, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(250)] + [(2, 0, "user", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    monkeypatch.setattr(conversations.Repair.__init__, "__defaults__", (64,))
    try:
        got = result(conversations.repair(conversations.damage(df)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows)


def test_empty_and_dropped(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversations.repair(conversations.damage(spark.createDataFrame([], schema))).count() == 0
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got = result(conversations.repair(conversations.damage(spark.createDataFrame([(7, turn, "user", "Hi.")], schema))))
    assert got == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query_over_the_table(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert result(queries.op12_conversation_repair(spark, sf)) == brute(rows)
