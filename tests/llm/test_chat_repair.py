"""Conversation repair against a plain search over whole audits."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from pricenet.llm import chat_repair
from pricenet.llm.chat_repair import repair_chats

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(name.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if harm == 0:
            continue
        text = "" if harm == 1 else "".join(c for c in text if c not in ".!?") if harm == 2 else text
        row = (conv, turn, "user" if harm == 4 else role, text)
        out += [row, row] if harm == 3 else [row]
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def plain_repair(rows):
    """States of the automaton of (s?(ua)+)? with whole audits and whole repaired lists."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}

    def inserts(best):
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                for r in "ua":
                    to = moves.get((state, r))
                    way = (cost + 3, audit + "I", [*lines, full[r] + ":"])
                    if to is not None and (to not in best or way[:2] < best[to][:2]):
                        best[to] = way
        return best

    best, seen = {"": (0, "", [])}, set()
    counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    for k, (_, _, role, text) in enumerate(rows):
        bare = text.rstrip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        if k and rows[k - 1][2][:1] + role[:1] not in ("su", "ua", "au"):
            counts["illegal"] += 1
        new = {}
        for state, (cost, audit, lines) in inserts(best).items():
            ways = [(state, cost + 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                late = 3 if fault == "truncated" else 0
                ways.append((moves.get((state, role[:1])), cost + late, "K", [f"{role}:{text}"]))
                ways += [(moves.get((state, r)), cost + 3 + late, "R", [f"{full[r]}:{text}"]) for r in "ua"]
            for to, c, letter, line in ways:
                way = (c, audit + letter, lines + line)
                if to is not None and (to not in new or way[:2] < new[to][:2]):
                    new[to] = way
        best = new
    cost, audit, lines = min((w for s, w in inserts(best).items() if s in ("", "a")), key=lambda w: w[:2])
    return counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = plain_damage([r for r in rows if r[0] == conv])
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, cost, audit, digest = plain_repair(own)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, digest)
    return out


def repaired(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("audit", F.lit(1))
    found = repair_chats(df).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:] for r in found}


def random_rows(n_convs, most, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n_convs):
        for turn in range(rng.randrange(most + 1)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sysop", "User"])
            text = rng.choice(["Yes.", "No!", "", " ", None, "cut", "Why?\n", "Ü.", "a b"]) if rng.random() < 0.6 else f"t{rng.random()}."
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, turn * 3]), role, text))
    return rows


def test_against_plain_search(spark):
    rows = random_rows(150, 9, 1)
    assert repaired(spark, rows) == plain(rows)


def test_one_conversation_over_many_spans(spark):
    # Over 30 spans in several partitions, and one row 2,000 times.
    rows = random_rows(6, 6, 2) + [(77, t, r, x) for _, t, r, x in random_rows(1, 1, 3)]
    rng = random.Random(4)
    for turn in range(6000):
        role = rng.choice(["user", "assistant", "tool"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
        rows.append((77, turn, role, rng.choice([f"x{turn}.", f"y{turn}.", "same.", "cut", ""])))
    rows += [(77, 10_000, "user", "again.")] * 2000
    assert repaired(spark, rows) == plain(rows)


def test_span_tables_join_like_whole_parse():
    rng = random.Random(5)
    for _ in range(40):
        rows = [(rng.choice("suat"), rng.choice([0, 0, 1, 2, 3])) for _ in range(12)]
        talk = chat_repair._Talk("c")
        for k, at in enumerate(range(0, 12, 4)):
            costs, ranks = chat_repair.span_table(rows[at:at + 4], chat_repair.STACKS)
            talk.add(0, k, costs, ranks, 0, [0, 0, 0], "u", "u")
        whole, _ = chat_repair.parse(rows, chat_repair.ROOT)
        assert chat_repair._close(talk.tops)[0] == chat_repair._close(whole)[0]


def test_grammar():
    assert [s.state for s in chat_repair.STACKS].count(2) == 2 and len(chat_repair.STACKS) == 8
    top = chat_repair.ROOT
    for symbol in "suaua":
        top = top.read(symbol)
    assert top.state in chat_repair.ACCEPTING and chat_repair.ROOT.read("a") is None


def test_awkward_tables(spark):
    assert repair_chats(spark.createDataFrame([], SCHEMA)).collect() == []
    far = [(1, -2**63, "user", "Hi."), (1, 2**63 - 1, "assistant", "Yes."), (2, None, None, None), (3, 0, "user", "x" * 200_000 + ".")]
    found = repaired(spark, far)
    assert found[1][0] is None and found[3][6] in ("KI", "D", "")
    assert {c: v[1:] for c, v in found.items()} == {c: v[1:] for c, v in plain(far).items()}


def test_same_names_as_contract(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    found = repair_chats(df)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == plain(rows)
