"""Secret scan with corpus-wide ownership: who else holds the same value decides what a candidate is.

1. Every text is searched for candidates: the base kinds (assignments, access keys, long hexadecimal runs) and added
   kinds (platform tokens, signed tokens, private keys). Only a digest of a value leaves the text.
2. Digests are counted over all documents by distinct repositories and distinct owners. Counting starts within each
   task and goes by (value, owner, repository), then (value, owner), then value, so an example that a third of all
   rows hold is a few rows after the first step.
3. A value of more than ``max_owners`` owners is a widely copied example. Any other value that looks random is
   ``live``; the rest is ``weak``. Base candidates are always reported; added ones unless they are examples.

Positions are code points, the end exclusive. Base rules, each leftmost and non-overlapping: a match that is too short
is dropped, but no other match may begin within it.

Defined results: a missing or empty text has no spans; a missing owner or repository counts as one owner or repository
of its own; rows that repeat an id are scanned each; an empty table gives an empty result.
"""

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import lookup, over_texts
from tickloom.session import materialize

MAX_OWNERS = 3
MIN_ENTROPY = 3.0
BASE_KINDS = 3

# Kind, pattern, least length and the group that is measured; base kinds first, in report order.
RULES = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 8, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 16, 0),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 32, 0),  # a whole run: what is shorter is dropped by the rule
    ("platform", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"), 0, 0),
    ("signed", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 0),
    ("key", re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}"), 0, 0),
]
# A text without any of these has no candidate; matched for a whole batch at once.
ANY_SIGN = r"(?i)passw|secret|token|api_?key|akia[a-z0-9]{12}|[0-9a-f]{32}|gh[pousr]_|xox[abprs]-|eyj|-----BEGIN "


def entropy(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def candidates(text: str) -> list:
    """``(start, kind, end, digest, random)`` by start and kind; kinds are numbered as in ``RULES``."""
    out = []
    for kind, (_, pattern, least, group) in enumerate(RULES):
        for m in pattern.finditer(text):
            value = m.group(group)
            if len(value) >= least:
                random = entropy(value) >= MIN_ENTROPY and any(c.isdigit() for c in value) and not value.isdigit()
                out.append((m.start(), kind, m.end(), hashlib.sha256(value.encode()).digest()[:16], random))
    return sorted(out)


SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.binary()), ("random", pa.bool_())])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_cols=("source", "lang")) -> DataFrame:
    """Per row: ``row_no, id, owner, repo, found``, written, so that ``row_no`` stays."""
    names = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in repo_cols]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.concat(F.lit("="), F.col(f"`{owner_col}`").cast("string")), F.lit("")).alias("owner"),
                       F.concat_ws("\x00", *names).alias("repo"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            found = [[]] * batch.num_rows
            for i in pc.indices_nonzero(pc.match_substring_regex(text, ANY_SIGN)).to_pylist():
                found[i] = [dict(zip(SPAN.names, c)) for c in candidates(text[i].as_py())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "owner", "repo")), pa.array(found, pa.list_(SPAN))],
                                             names=["id", "owner", "repo", "found"])

    spans = over_texts(rows, run, f"id {id_type}, owner string, repo string, found array<struct<start:long,kind:int,end:long,value:binary,random:boolean>>")
    return materialize(spans.withColumn("row_no", F.monotonically_increasing_id()), "secret-spans")


def ownership(found: DataFrame) -> DataFrame:
    """Per value: ``value, owners, repos, places``."""
    each = found.select("owner", "repo", F.explode("found.value").alias("value"))
    per_repo = each.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("places"))
    per_owner = per_repo.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("places").alias("places"))
    return per_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.sum("places").alias("places"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_cols=("source", "lang"), max_owners: int = MAX_OWNERS) -> DataFrame:
    """Per row: ``id, spans``, spans being ``(start, kind, end, verdict, owners, repos)`` in order."""
    found = find(docs, id_col, text_col, owner_col, repo_cols)
    owned = materialize(ownership(found), "secret-owners")
    each = found.where(F.size("found") > 0).select("row_no", F.explode("found").alias("c")).select("row_no", "c.*")
    verdict = F.when(F.col("owners") > max_owners, "example").when(F.col("random"), "live").otherwise("weak").alias("verdict")
    judged = lookup(each, owned, "value").select("row_no", F.struct("start", "kind", "end", verdict, "owners", "repos").alias("s"))
    stays = judged.where((F.col("s.kind") < BASE_KINDS) | (F.col("s.verdict") != "example"))
    per_row = stays.groupBy("row_no").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    return found.select("row_no", "id").join(per_row, "row_no", "left").select("id", F.coalesce("spans", F.array()).alias("spans"))


def summary(scanned: DataFrame) -> DataFrame:
    """Per row: counts of the base kinds, a digest of the base spans, all spans as a string, and verdicts."""
    kinds = F.array(*[F.lit(name) for name, *_ in RULES])

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def is_kind(k):
        return lambda s: s["kind"] == k

    return scanned.select(
        "id", *[count(is_kind(k)).alias(f"n_{RULES[k][0]}") for k in range(BASE_KINDS)],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < BASE_KINDS)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"), count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "example").alias("n_example"))
