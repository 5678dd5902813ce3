import random
import re
import time
from collections import defaultdict

from pyspark.sql import functions as F

from sigweave.llm import chat_quotes

SCHEMA = "conv_id long, turn long, role string, text string, depth string, h string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def norm(t):
    return re.sub(r"\s+", " ", t.lower()).strip(" ")


def brute(rows):
    """Passages, links and threads by plain loops."""
    said, out = defaultdict(dict), []
    parsed = []
    for c, t, r, x in rows:
        x = x or ""
        lines = re.split(r"\r\n|\r|\n", x)
        runs = []
        if re.search(r"(?m)^[ \t]*>", x):
            for line in lines:
                marks = re.match(chat_quotes.MARKS, line)
                depth = marks[0].count(">") if marks else 0
                body = line[marks.end() :] if marks else line
                if runs and runs[-1][0] == depth:
                    runs[-1][1].append(body)
                else:
                    runs.append((depth, [body]))
            own = [b for d, bs in runs for b in bs if not d]
            content = re.sub(r"^\n+|\n+$", "", re.sub(r"\n{3,}", "\n\n", "\n".join(own)))
        else:
            content = x
        parsed.append((c, t, r, content, [q for q in runs if q[0]]))
        if c is not None and t is not None:
            for p in {content, *re.split(r"\n[ \t]*\n", content), *content.split("\n")}:
                if len(norm(p)) >= chat_quotes.LEAST:
                    k = norm(p)
                    said[c][k] = min(said[c].get(k, t), t)
    parent, links = {}, defaultdict(int)
    for c, t, _, _, quoted in parsed:
        for depth, bodies in quoted:
            bodies = [b for b in bodies if b.strip(" ")]
            found = [said[c][norm(" ".join(bodies))]] if said[c].get(norm(" ".join(bodies)), t) < t and len(norm(" ".join(bodies))) >= chat_quotes.LEAST else [said[c][norm(b)] for b in bodies if said[c].get(norm(b), t) < t and len(norm(b)) >= chat_quotes.LEAST]
            if found:
                links[c, t] += 1
                if depth == 1:
                    parent[c, t] = max(parent.get((c, t), -1), max(found))
    for c, t, r, content, quoted in parsed:
        root, depth = t, 0
        while (c, root) in parent:
            root, depth = parent[c, root], depth + 1
        out.append((c, t, r, content, parent.get((c, t)), root, depth, len(quoted), links.get((c, t), 0)))
    order = sorted(out, key=lambda m: [(x is None, x or 0) for x in (m[0], m[5], m[1])])
    count, placed = defaultdict(int), []
    for m in order:
        placed.append((m[0], count[m[0]], *m[1:]))
        count[m[0]] += 1
    return placed


def threads(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(12):
        texts = []
        for t in range(rng.randint(1, 14)):
            text = "\n\n".join(f"This is sentence {rng.random():.6f} of {c}\nand one more line {rng.random():.5f}" for _ in range(rng.randint(1, 3)))
            if texts and rng.random() < 0.7:
                asked = rng.choice(texts)
                if rng.random() < 0.5:
                    asked = rng.choice(asked.split("\n\n"))
                mark = rng.choice(["> ", ">", "  > "])
                text = "\n".join(mark + line.upper() if rng.random() < 0.3 else mark + line for line in asked.split("\n")) + "\n" + text
            texts.append(text)
            rows.append((c, t, "user", text))
    rng.shuffle(rows)
    return rows


def test_links_threads_and_positions(spark):
    rows = threads(3) + [(90, 0, "user", None), (90, 1, "user", ""), (91, 0, None, "> nothing known here at all\nyes"), (None, 1, "user", "> x"), (92, None, "user", "lost"), (93, 0, "user", "long " * 40_000)]
    got = chat_quotes.chats(table(spark, rows)).collect()
    want = brute(rows)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert any(m[7] > 1 for m in want) and any(m[9] for m in want)


def test_nested_quotes_and_attribution(spark):
    rows = [
        (1, 0, "a", "The first message is here."),
        (1, 1, "b", "On Monday a wrote:\n> The first message is here.\nAnd the second replies."),
        (1, 2, "c", "b wrote:\n>> The first message is here.\n> And the second replies.\nThird."),
    ]
    got = {r.turn: r for r in chat_quotes.chats(table(spark, rows)).collect()}
    assert [got[t].content for t in range(3)] == ["The first message is here.", "And the second replies.", "Third."]
    assert [got[t].parent_turn for t in range(3)] == [None, 0, 1]
    assert [got[t].reply_depth for t in range(3)] == [0, 1, 2] and {r.thread_turn for r in got.values()} == {0}
    assert got[2].n_quoted == got[2].n_linked == 2


def test_repeats_and_no_rows(spark):
    rows = [(1, 0, "a", "said once or twice"), (1, 0, "a", "said once or twice"), (1, 1, "b", "> said once or twice\nyes")]
    got = chat_quotes.chats(table(spark, rows)).collect()
    assert sorted((r.position, r.turn, r.parent_turn) for r in got)[2] == (2, 1, 0) and len(got) == 3
    assert chat_quotes.chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python(spark):
    plan = chat_quotes.parsed(table(spark, threads(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_long_quotes_are_linear(spark):
    """A message of 100,000 quoted lines, of one depth and of depths in turn: some seconds each."""
    texts = ["\n".join(f"> line {k} of many" for k in range(100_000)), "\n".join(f"{'>' * (1 + k % 3)} line {k} of many" for k in range(100_000))]
    for text, runs in zip(texts, (1, 100_000), strict=True):
        began = time.time()
        got = chat_quotes.parsed(table(spark, [(1, 0, "a", text)])).select(F.size("quoted").alias("n"), F.col("quoted")[0]["bodies"].alias("first"), F.aggregate("quoted", F.lit(0), lambda n, p: n + F.size(p["bodies"])).alias("lines")).first()
        assert (got.n, got.lines) == (runs, 100_000) and got.first[0] == "line 0 of many"
        assert time.time() - began < 60


def test_short_passages_link_if_asked_to(spark):
    long_name = "Somebody whose name is long " * 20
    rows = [(1, 0, "a", "Yes."), (1, 1, "b", f"{long_name} wrote:\n> Yes.\nNo."), (1, 2, "c", "> No.\nWell.")]
    parents = lambda least: [r.parent_turn for r in sorted(chat_quotes.chats(table(spark, rows), least=least).collect(), key=lambda r: r.turn)]
    assert parents(1) == [None, 0, 1] and parents(12) == [None, None, None]
    assert {r.content for r in chat_quotes.chats(table(spark, rows)).collect()} == {"Yes.", "No.", "Well."}
