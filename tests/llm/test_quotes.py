"""Quotation linking on small mail threads, and against its SQL twin."""

from __future__ import annotations

import duckdb

from brookmill.llm import quotes
from tests.llm.common import same_rows

SCHEMA = "conv_id long, turn long, role string, text string, parent long, hash string, lines string"
FIRST = "Shall we meet?\nThe old  room is free."
SECOND = "Yes.\n> the old room is free.\nWhich day?"
THIRD = "Ann wrote:\n> Yes.\n> > Shall we meet?\n>> The old room is free.\n> Which day?\n\nMonday: noon"
ROWS = [
    (1, 0, "user", FIRST),
    (1, 1, "assistant", SECOND),
    (1, 2, "user", THIRD),
    (1, 3, "assistant", "> nobody said this\nindeed"),
    (1, 4, "user", "> Shall we meet?\r\n>\r\n> Monday: noon\r\n> \r\n> unknown\r\nfine"),
    (1, 5, "user", ">> Which day?"),
    (2, 0, "user", "> Shall we meet?"),
    (2, 1, "user", None),
    (2, 2, "user", ""),
    (2, 2, "user", ""),
    (2, 2, "user", ">\n> \n>"),
    (None, 1, "user", "> a\na"),
    (3, None, "user", "> a"),
    (4, 7, None, "x " * 20000 + "\n" + "> y\n" * 3000),
    (4, 8, None, "> x\n> x x\n\n> " + "x " * 700),
    # Short messages that come again, and quotations of one or of both.
    (6, 0, "user", "Yes."),
    (6, 1, "user", "Thanks."),
    (6, 7, "user", "Yes.\nThanks."),
    (6, 8, "user", "> Yes.\n> Thanks.\nwhat for?"),
    (6, 9, "user", "> Thanks.\nno"),
    (6, 3000, "user", "> what\n> for?\n\n> yes"),
    # Wrapped anew, a part of a message, words that only begin alike.
    (7, 0, "user", "The meeting is moved to the large room\nbecause so many people want to come and listen."),
    (7, 1, "user", "> The meeting is moved\n> to the large room because so many\n> people want to come\n> and listen.\nGood."),
    (7, 2, "user", "> so many people want to\n>> Good\nindeed"),
    (7, 3, "user", "A line that announces, " + "and goes on, " * 40 + "as follows:\n> Good.\n> the large roo"),
]


def frame(spark):
    return spark.createDataFrame([(*r, 9, "h", "l") for r in ROWS], SCHEMA).repartition(4)


def test_links_and_roots(spark):
    got = {(r["conv_id"], r["turn"]): r for r in quotes.reply_order(frame(spark)).filter("conv_id IN (1, 4, 6, 7)").collect()}
    assert [got[1, t]["parent_turn"] for t in range(6)] == [None, 0, 1, None, 0, 1]  # three words of turn 0 against two of turn 2
    assert [got[1, t]["root_turn"] for t in range(6)] == [0, 0, 0, 3, 0, 0]
    assert got[1, 2]["own_text"] == "Monday: noon"
    assert (got[1, 2]["n_passages"], got[1, 2]["n_linked"], got[1, 2]["deepest"]) == (3, 3, 2)
    assert (got[1, 4]["n_passages"], got[1, 4]["n_linked"]) == (3, 2)
    assert got[4, 8]["parent_turn"] == 7 and got[4, 8]["n_linked"] == 2
    assert [got[6, t]["parent_turn"] for t in (7, 8, 9)] == [None, 7, 7]
    assert got[6, 3000]["parent_turn"] == 8 and got[6, 3000]["n_linked"] == 1
    assert [got[7, t]["parent_turn"] for t in (1, 2, 3)] == [0, 0, None]
    assert (got[7, 2]["n_linked"], got[7, 3]["own_text"]) == (1, "")


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    same_rows(quotes.reply_order(frame(spark)), con, quotes.SQL)


def test_long_chain(spark):
    rows = [(5, i, "u", f"line {i}\n> line {i - 1}") for i in range(40)]
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["root_turn"] for r in got} == {0}
    assert all(r["parent_turn"] == (r["turn"] - 1 if r["turn"] else None) for r in got)


def test_random_threads_equal_sql(spark):
    """Few words, so that passages stand in many messages, with quotes of quotes and blank lines."""
    import random

    rng = random.Random(3)
    say = lambda: " ".join(rng.choices(["yes", "No", "so", "it", "is"], k=rng.randint(1, 12)))
    rows = []
    for conv in range(30):
        turns = sorted(rng.sample(range(5000), 12))
        said = []
        for t in turns:
            lines = [say() for _ in range(rng.randint(0, 2))]
            for old in rng.sample(said, min(len(said), rng.randint(0, 2))):
                words = " ".join(x for x in old.split() if x != ">").split()
                part = words[rng.randint(0, len(words) // 2) :] or ["so"]
                at = rng.randint(0, len(part))
                lines += [rng.choice(["> ", ">> ", "> > "]) + " ".join(part[:at]), rng.choice(["> ", ">> "]) + " ".join(part[at:]), rng.choice(["", "ok"])]
            said.append("\n".join(lines))
            rows.append((conv, t, "u", said[-1]))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    done = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    same_rows(done, con, quotes.SQL)
    assert done.filter("n_linked > 0").count() > 100


def test_empty_table(spark):
    assert quotes.reply_order(spark.createDataFrame([], SCHEMA)).count() == 0
