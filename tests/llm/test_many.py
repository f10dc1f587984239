"""Texts with very many findings, and keys that a third of the rows have."""

import random
import time

from pyspark.sql import functions as F

from lodestream.llm import neardup, secrets, sharding


def findings_of(text):
    """(start, end) of what every rule finds, by the rules' own definition."""
    import re

    out = []
    for r in secrets.RULES:
        for m in re.finditer(r.pattern.replace("(?i:password|passwd|secret|token|api_?key)", "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"), text):
            if len(m.group(r.group)) >= r.least:
                out.append(m.span())
    return sorted(out)


def masked(text, mask="[secret]"):
    out, at = [], 0
    for a, b in findings_of(text):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_redaction_equals_a_plain_one(spark):
    r = random.Random(8)
    bits = ["é漢", " plain words ", "token=AKIA" + "A" * 16, "secret: " + "0123456789abcdef" * 3, "AKIA" + "B" * 20, "f" * 40, "password = short", "\n", "🙂", "api_key=" + "Ab1" * 5, "eyJabcdefgh.eyJabcdefgh.abcdefgh1"]
    texts = ["".join(r.choices(bits, k=r.randint(0, 12))) for _ in range(150)] + ["", None, "f" * 40, "x" + "f" * 40 + "é"]
    got = secrets.redact(spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")).collect()
    assert len(got) == len(texts)
    for row in got:
        t = texts[row["doc_id"]]
        assert row["text"] == (None if t is None else masked(t)), t
        assert t is None or row["n_chars"] == len(row["text"])


def test_time_follows_the_findings(spark):
    def seconds(n):
        text = " ".join(f"token=abcdefgh{i} é" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        assert secrets.redact(df).first()["text"].count("[secret]") == n
        assert secrets.scan_documents(df).first()["n_assign"] == n
        return time.time() - began

    seconds(500)
    few, many = seconds(16_000), seconds(32_000)
    assert many < 2.8 * few + 1, (few, many)


def test_a_rescan_shows_a_finding_once(spark):
    df = spark.createDataFrame([("token=abcdefgh1 " * 50,)], "text string")
    once = secrets.scan_history(df)
    twice = once.unionByName(once)
    assert [len(r["spans"]) for r in secrets.current(twice).collect()] == [50] and len(secrets.masked(twice).first()["spans"]) == 50


def test_a_text_that_a_third_of_the_rows_share_is_dealt_and_linked(spark):
    text = F.when(F.col("id") % 3 == 0, "one text that very many rows share word for word").when(F.col("id") % 3 == 1, F.concat(F.lit("size of this is "), F.lpad(F.col("id").cast("string"), 6, "0"))).otherwise(F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), F.floor(F.col("id") / 3).cast("string")) for k in range(12)], F.concat(F.lit("end"), F.col("id").cast("string"))))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), text.alias("text"))
    got = sharding.shard_by_size(docs, 40).collect()
    assert len(got) == 6000
    loads, slots = {}, {}
    for r in got:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    shared = {r["shard"] for r in got if r["doc_id"] % 3 == 0}
    assert len(shared) == 1
    rest = [v for s, v in loads.items() if s not in shared]
    assert max(rest) - min(rest) <= 400
    near = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, 2, 80).collect()}
    assert all(near[i] == (0 if i % 3 == 0 else i) for i in range(6000) if i % 3 != 1)
