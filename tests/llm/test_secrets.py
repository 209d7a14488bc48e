import hashlib
import math
import random
import re
from collections import Counter

from scholar_lake.llm import secrets
from scholar_lake.llm.queries import F

KINDS = secrets.KINDS


def base(text):
    text, spans = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def entropy(window):
    return -sum(c / len(window) * math.log2(c / len(window)) for c in Counter(window).values())


ALLOWED = [r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "(?ai:sha)(?:256|384|512)-", "(?ai:example)",
           "(?ai:placeholder)", "(?ai:0123456789abcdef)", "(?ai:abcdefghijklmnopqrstuvwxyz)"]


def method(text):
    found, whole = [], text or ""
    for pattern in ALLOWED:
        whole = re.sub(pattern, lambda m: " " * len(m[0]), whole)
    for kind, (characters, least, needs) in secrets.CLASSES.items():
        for m in re.finditer(f"[{characters}]{{{secrets.WINDOW},}}", whole):
            run = m[0]
            if not all(re.search(n, run) for n in needs):
                continue
            hot = [i for i in range(len(run) - secrets.WINDOW + 1) if entropy(run[i:i + secrets.WINDOW]) >= least - 1e-9]
            if hot:
                found.append((m.start() + hot[0], KINDS.index(kind), m.start() + hot[-1] + secrets.WINDOW))
    return sorted(s for s in found if not any(b[0] <= s[0] and b[2] >= s[2] for b in base(text)))


def test_matches_brute_force(spark, awkward):
    rng = random.Random(4)
    alphabet = "abcdefABCDEF0123456789+/_-=XYZxyz"
    texts = [None, "", "token: secret: abcdefgh12", "Api_Key='aaaaaaaa' é PASSWORD = \"0123456789.abc", "token=secret=abcdefgh",
             "AKIAAKIAAKIAAKIA AKIA123 xAKIA0123456789AB", "f" * 40, "0123456789abcdef" * 3, "paſſword = abcdefgh1", "toKen = abcdefgh1",
             "123e4567-e89b-12d3-a456-426614174000", "password:" + "a" * 100000]
    for _ in range(60):
        parts = ["".join(rng.choice(alphabet[:rng.choice([16, 22, 33])]) for _ in range(rng.randint(5, 60))) for _ in range(6)]
        texts.append("é ".join(rng.choice(["", "token=", "Secret : ", "eXample", "2024-01-01-", "Sha256-", "/placeholder/"]) + p for p in parts))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string").withColumn("base_spans", F.lit(1))
    rows = secrets.find_secrets(docs).select("text", "base_spans", "method_spans", secrets.listed(F.col("base_spans")).alias("l")).collect()
    assert len(rows) == 2 * len(texts) and any(r.method_spans for r in rows)
    for r in rows:
        assert [tuple(s) for s in r.base_spans] == base(r.text)
        assert [tuple(s) for s in r.method_spans] == method(r.text)
        assert r.l == ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base(r.text))
    assert secrets.find_secrets(awkward).count() == awkward.count()


def test_keys_of_one_case(spark):
    rng = random.Random(9)
    lower, upper = ("".join(rng.choice(a) for _ in range(40)) for a in ("abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    texts = [f"key {lower} end", f"key {upper} end", "internationalisation2internationalisation", "A" * 30 + "123", "1234567890" * 4]
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[(s.start, KINDS[s.kind], s.end) for s in r.method_spans] for r in rows] == [[(4, "entropy_lower", 44)], [(4, "entropy_upper", 44)], [], [], []]


def test_allowed_words_suppress_only_what_they_touch(spark):
    key = "q7Xn2Lp9Vb4Tz8Rk1Wd6Ys3Hf5Jm0Gcu"
    texts = [f"2024-01-01-{key}", f"/example/{key}", f"{key}placeholder{key}", f"{key[:16]}EXAMPLE{key[16:]}", "x 123e4567-e89b-12d3-a456-426614174000 y",
             f"sha512-{key}", f"{key}123e4567-e89b-12d3-a456-426614174000"]
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    spans = [[(s.start, s.end) for s in r.method_spans if KINDS[s.kind] == "entropy_base64"] for r in rows]
    assert spans == [[(10, 43)], [(8, 41)], [(0, 32), (43, 75)], [], [], [(7, 39)], [(0, 32)]]


def test_many_matches_take_time_in_proportion(spark):
    for n in (255, 256, 257, 100_000):
        docs = spark.createDataFrame([("é token=abcdefgh1" * n,)], "text string")
        spans = docs.select(secrets.matches(F.col("text"), secrets.ASSIGN).alias("m")).select(
            F.size("m").alias("n"), F.element_at("m", -1).alias("last"), F.get("m", F.lit(n // 2)).alias("middle")).first()
        assert (spans.n, spans.last.start, spans.middle.start) == (n, 17 * (n - 1) + 2, 17 * (n // 2) + 2)


def test_no_rows(nothing):
    assert secrets.find_secrets(nothing).count() == 0


def test_digest_of_no_spans(spark):
    empty = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert secrets.find_secrets(empty).select(F.sha2(secrets.listed(F.col("base_spans")), 256)).first()[0] == hashlib.sha256(b"").hexdigest()
