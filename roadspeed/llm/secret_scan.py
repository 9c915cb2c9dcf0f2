"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns give spans in every whole text. Longer mixed tokens are further candidates. The hashes of all candidate
values are counted over the corpus by distinct repositories and owners: what many copy is an example, what one owner
alone holds in few places looks live. Live tokens are added to the spans; base spans stay in any case.

Null text is empty. A null owner or repository counts as one of its own. Equal rows of one id count once in the counts
of its live and copied values. Positions are code points, the end exclusive. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspeed.session import materialise

# Fixed values of the base scan: kind, pattern, group that holds the value, least length of the value.
KINDS = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# The method's own candidates: runs of token characters with a digit, a small and a capital letter.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
SPAN = "struct<start:int,rank:int,end:int,kind:string,hash:string>"


def located(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """Array of ``SPAN`` of the leftmost, non-overlapping matches whose value has ``least`` characters.

    The pieces between the matches, and the matches, give the positions by running sums.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)).alias("gap"), whole.alias("match"), value.alias("value")
    )

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            F.sha2(x["value"], 256).alias("hash"),
        ).cast(SPAN)
        out = F.when(F.length(x["value"]) >= least, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    none = F.array().cast(f"array<{SPAN}>")
    spans = F.aggregate(found, F.struct(F.lit(0).alias("at"), none.alias("out")), add)["out"]
    return F.when(text.rlike(pattern), spans).otherwise(none)


def scan(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """(_id, _repo, _owner, base, tokens): the spans of every whole text."""
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(repo_col).cast("string").alias("_repo"),
        F.col(owner_col).cast("string").alias("_owner"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    text = F.col("_text")
    base = F.concat(*(located(text, kind, rank, *rest) for rank, (kind, *rest) in enumerate(KINDS)))
    tokens = located(text, "token", len(KINDS), TOKEN, 0, 20)
    rows = rows.select("_id", "_repo", "_owner", "_text", F.array_sort(base).alias("base"), tokens.alias("found"))
    value = lambda s: F.substring(F.col("_text"), s["start"] + 1, s["end"] - s["start"])
    mixed = lambda s: value(s).rlike("[0-9]") & value(s).rlike("[a-z]") & value(s).rlike("[A-Z]")
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return rows.select("_id", "_repo", "_owner", "base", F.filter("found", lambda s: mixed(s) & apart(s)).alias("tokens"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repos): in how many distinct owners and repositories each candidate value stands."""
    once = candidates.groupBy("hash", "_owner", "_repo").agg(F.count("*").alias("n"))  # copies end here, before the shuffle
    own = F.coalesce("_owner", F.lit("")), F.col("_owner").isNull()
    held = F.coalesce("_repo", F.lit("")), F.col("_repo").isNull()
    by_owner = once.groupBy("hash", "_owner").agg(F.count_distinct(*held).alias("repos"))
    return by_owner.groupBy("hash").agg(F.count_distinct(*own).alias("owners"), F.max("repos").alias("repos"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
    max_owners: int = 1, max_repos: int = 3,
) -> DataFrame:
    """(id, base, spans, n_live, n_copied) per document; the arrays hold ``SPAN``.

    A value is live if at most ``max_owners`` owners hold it, each in at most ``max_repos`` repositories.
    """
    found = materialise(scan(docs, id_col, text_col, repo_col, owner_col), "secrets")
    each = found.select("_id", "_repo", "_owner", F.explode(F.concat("base", "tokens")).alias("span"))
    each = each.select("_id", "_repo", "_owner", "span", F.col("span.hash").alias("hash"))
    counts = ownership(each)
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    judged = each.join(counts.select("hash", live.alias("live")), "hash")
    added = F.when(F.col("live") & (F.col("span.kind") == "token"), F.col("span"))
    per_doc = judged.groupBy("_id").agg(
        F.collect_set(added).alias("added"), F.count_distinct(F.when(F.col("live"), F.col("span"))).alias("n_live"),
        F.count_distinct(F.when(~F.col("live"), F.col("span"))).alias("n_copied"),
    )
    none = F.array().cast(f"array<{SPAN}>")
    out = found.join(per_doc, "_id", "left")
    return out.select(
        F.col("_id").alias(id_col), "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
