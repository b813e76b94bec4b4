import hashlib
import random
import re
import zlib
from functools import cmp_to_key

import pytest

from articlemill.llm import conversation_repair as repair
from articlemill.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SOUND_ROLES = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def every_plan(rows, most):
    """All `(cost, audit, repaired)` of at most `most`, by trying every edit; rows are (role, text, kind)."""
    found = []

    def go(i, cost, audit, turns):
        if cost > most:
            return
        if i == len(rows) and SOUND_ROLES.fullmatch("".join(r[:1] or "-" for r, _ in turns)):
            found.append((cost, audit, turns))
        for role in ("user", "assistant"):
            go(i, cost + 5, audit + "I", [*turns, (role, "")])
        if i < len(rows):
            role, text, kind = rows[i]
            go(i + 1, cost + 2, audit + "D", turns)
            if kind != "d":
                more = 5 * (kind == "t")
                go(i + 1, cost + more, audit + "K", [*turns, (role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, cost + 1 + more, audit + "R", [*turns, (other, text)])

    go(0, 0, "", [])
    return found


def brute_report(rows):
    """The report on the rows of one conversation, from the definitions."""
    def order(a, b):
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
        return (key(a) > key(b)) - (key(a) < key(b))

    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=cmp_to_key(order))
    counts, seen, kinds = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        full = [c for c in text if c not in " \t\n\x0b\f\r"]
        fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else None
        seen.add((role, text))
        counts[fault] = counts.get(fault, 0) + 1
        kinds.append({"blank": "d", "duplicate": "d", "truncated": "t", None: "k"}[fault])
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    plans = every_plan([(r, x, k) for (_, r, x), k in zip(rows, kinds, strict=True)], 2 * len(rows))
    cost, audit, turns = min(plans, key=lambda p: p[:2])
    text = "\n".join(f"{r}:{x}" for r, x in turns)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def reports(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_alignment_agrees_with_every_plan():
    draw = random.Random(2)
    for n in range(6):
        for _ in range(60):
            rows = [(draw.choice("ssuuaaax"), draw.choice("kkkktd")) for _ in range(n)]
            plans = every_plan([({"s": "system", "u": "user", "a": "assistant", "x": "tool"}[r], "", k) for r, k in rows], 2 * n)
            expected = min(p[:2] for p in plans)
            assert repair.aligned(rows)[:2] == expected, rows
            assert repair.folded(rows)[:2] == expected, rows


def test_folded_columns_agree_with_the_band():
    draw = random.Random(3)
    for n in (17, 40, 120, 300):
        for _ in range(6):
            good = "s" * draw.randint(0, 1) + "ua" * n
            rows = [(draw.choice("suax") if draw.random() < 0.2 else r, draw.choice("ktd") if draw.random() < 0.2 else "k") for r in good[:n]]
            assert repair.aligned(rows) == repair.folded(rows)


def test_ties_go_to_the_least_audit():
    rows = [("u", "k"), ("u", "k"), ("a", "k"), ("a", "k")]
    assert repair.aligned(rows)[:2] == (2, "KRRK")
    assert repair.aligned([("u", "k")])[:2] == (2, "D")
    assert repair.aligned([("s", "k")])[:2] == (2, "D")
    assert repair.aligned([])[:2] == (0, "")


def conversations(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def odd_rows():
    draw, rows = random.Random(4), []
    for conv in [*range(40), None]:
        for _ in range(draw.randint(1, 6)):
            turn = draw.choice([None, 0, 1, 2, 3, 7, 7])
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, turn, role, draw.choice(["Yes.", "No!", "cut", "", " \n", "Ünï?  ", None, "long " * 5000 + "."])))
    return [*rows, rows[0], rows[0]]


def test_reports_agree_with_brute_force(spark):
    rows, groups = odd_rows(), {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(row)
    df = conversations(spark, rows).selectExpr("*", "1 AS last", "'x' AS digest", "2 AS conv", "3 AS edit")
    found = reports(repair.repair_report(df))
    assert found == {conv: brute_report(group) for conv, group in groups.items()}
    turns = {}
    for r in sorted(repair.repaired_turns(df).collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.place == len(turns[r.conv_id]) - 1
    for conv, report in found.items():
        assert hashlib.sha256("\n".join(turns.get(conv, [])).encode()).hexdigest() == report[-1]


def test_long_conversations_and_empty_tables(spark):
    draw = random.Random(6)
    rows = [(1, i, draw.choice(["user", "assistant"]), f"Turn {i}.") for i in range(2500)]
    (report,) = repair.repair_report(conversations(spark, rows)).collect()
    initials = [(r[2][0], "k") for r in rows]
    assert (report.cost, report.audit) == repair.folded(initials)[:2]
    kept = repair.repaired_turns(conversations(spark, rows))
    assert SOUND_ROLES.fullmatch("".join(r.role[0] for r in kept.orderBy("place").collect()))
    assert repair.repair_report(conversations(spark, []).limit(0)).count() == 0
    assert repair.repaired_turns(conversations(spark, []).limit(0)).count() == 0


def brute_damage(rows):
    groups = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        group = groups.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            group += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return groups


@pytest.mark.parametrize("folder", ["sf0.001", "odd"])
def test_the_query_agrees_with_brute_force(spark, folder, tmp_path):
    if folder == "odd":
        path = str(tmp_path)
        conversations(spark, odd_rows()).write.parquet(f"{path}/conversations.parquet")
    else:
        path = f"/root/testdata/{folder}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {conv: brute_report(group) if group else (0, 0, 0, 0, 0, 0, "", EMPTY) for conv, group in brute_damage(rows).items()}
    assert reports(queries.op13_conversation_repair(spark, path)) == expected
