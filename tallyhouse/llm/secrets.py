"""Secret scans with multipart credential linking, in DataFrame functions only.

Base kinds are reported wherever they match. Weak kinds are reported only with
their complement: a credential is an access identifier, a secret and, often, an
endpoint, in one scope (a part of the text between blank lines). Matches are
intervals, joined to the scope's interval in which they begin; which roles a scope
holds says of each part whether its complement is there. So intervals are joined
without making pairs, however many a scope has and however far apart they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.common import identified

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_ASSIGNED = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ASSIGNED_CHARS = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_CHARS = 20
HEX = r"[0-9a-f]+"
HEX_CHARS = 24
#: Weak kinds: an account name, a long mixed token, a place to use them.
CLIENT = r"""(?i:client_?id|access_?id|account|user_?name|username|login|user)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
BLOB = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"""(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}:[0-9]{2,5}(?![0-9])"""
SCOPE_END = r"\n[\x20\t]*\n"

BASE_KINDS = ["assign", "access", "hex"]
WEAK_KINDS = ["client", "blob", "endpoint"]
#: What a kind is part of a credential as. Base hex runs are secrets too.
ROLES = {"access": "identifier", "client": "identifier", "assign": "secret", "hex": "secret", "blob": "secret", "endpoint": "endpoint"}
#: For a weak kind, the sets of roles of which one must be in its scope as a whole.
COMPLEMENTS = {"client": [["secret"]], "blob": [["identifier"], ["endpoint"]], "endpoint": [["identifier", "secret"]]}


def _found(text: Column, pattern: str) -> Column:
    """Matches of a pattern, in order: array of (gap, match), gap being how many
    code points lie between the match and the one before. Null without matches."""
    pairs = F.zip_with(
        F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")),
    )
    # After the last match comes one more gap.
    return F.when(text.rlike(pattern), F.filter(pairs, lambda pair: pair["match"].isNotNull()))


def _holds(kind: str, match: Column) -> Column:
    """Whether a match is one of the base kind; others only count as gaps."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, _ASSIGNED, 1)) >= ASSIGNED_CHARS
    return F.length(match) >= {"access": ACCESS_CHARS, "hex": HEX_CHARS}.get(kind, 1)


def secret_parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, version, kind, start, end, scope): all matches, weak ones too, with
    the number of the scope they begin in. Offsets are code points, end exclusive.

    Weak matches and scopes are looked for in texts that have more than one role.
    """
    rows = identified(docs, doc_id, text)
    # A run of hex digits that is too short is no gap to keep: only long ones match.
    own = {
        "assign": _found(F.col("text"), ASSIGN), "access": _found(F.col("text"), ACCESS),
        "hex": _found(F.col("text"), HEX[:-1] + f"{{{HEX_CHARS},}}"),
    }
    base = rows.select("*", *[found.alias(kind) for kind, found in own.items()])
    weak = base.select(
        "*", *[_found(F.col("text"), pattern).alias(kind) for kind, pattern in
               (("client", CLIENT), ("blob", BLOB), ("endpoint", ENDPOINT))]
    )
    roles = {}
    for kind, role in ROLES.items():
        roles[role] = roles.get(role, F.lit(False)) | F.col(kind).isNotNull()
    several = sum((there.cast("int") for there in roles.values()), F.lit(0)) > 1
    weak_there = F.col("client").isNotNull() | F.col("blob").isNotNull() | F.col("endpoint").isNotNull()
    scoped = weak.withColumn("linking", several & weak_there).withColumn(
        "scope_end", F.when(F.col("linking"), _found(F.col("text"), SCOPE_END))
    )
    kept = lambda kind: F.col(kind) if kind in BASE_KINDS else F.when(F.col("linking"), F.col(kind))
    kinds = [*BASE_KINDS, *WEAK_KINDS, "scope_end"]
    some = F.array_compact(F.array(*[
        F.when(kept(kind).isNotNull(), F.struct(F.lit(kind).alias("kind"), kept(kind).alias("found"))) for kind in kinds
    ]))
    listed = scoped.select("doc_id", "version", F.explode(some).alias("of")).select(
        "doc_id", "version", "of.kind", F.posexplode("of.found").alias("nth", "at")
    )
    holds = F.coalesce(*[F.when(F.col("kind") == kind, _holds(kind, F.col("at.match"))) for kind in kinds])
    # Rows with the same id and text have the same matches; they are listed once.
    each = listed.select(
        "doc_id", "version", "kind", "nth", F.col("at.gap").alias("gap"), F.length("at.match").alias("chars"), holds.alias("holds")
    ).distinct()
    so_far = Window.partitionBy("doc_id", "version", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("chars")).over(so_far)).where("holds").select(
        "doc_id", "version", "kind", (F.col("end") - F.col("chars")).alias("start"), "end"
    )
    by_start = Window.partitionBy("doc_id", "version").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, 0)
    scopes = placed.withColumn("scope", F.count(F.when(F.col("kind") == "scope_end", 1)).over(by_start))
    return scopes.where("kind <> 'scope_end'")


def linked_parts(parts: DataFrame) -> DataFrame:
    """The parts to report: all base ones, and weak ones with their complement.

    A weak part that overlaps a base one is left out, as that one tells of it.
    """
    role = F.coalesce(*[F.when(F.col("kind") == kind, role) for kind, role in ROLES.items()])
    scope = Window.partitionBy("doc_id", "version", "scope")
    order = scope.orderBy("start", "end", "kind")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    is_base = F.col("kind").isin(BASE_KINDS)
    last = F.max(F.when(is_base, F.col("end"))).over(before)
    following = F.min(F.when(is_base, F.col("start"))).over(after)
    rows = parts.withColumn("role", role).withColumns({
        **{f"has_{name}": F.max(F.col("role") == name).over(scope) for name in ("identifier", "secret", "endpoint")},
        "told": F.coalesce(last > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False)),
    })
    report = is_base
    for kind, sets in COMPLEMENTS.items():
        complete = F.lit(False)
        for names in sets:
            together = F.lit(True)
            for name in names:
                together = together & F.col(f"has_{name}")
            complete = complete | together
        report = report | ((F.col("kind") == kind) & ~F.col("told") & complete)
    return rows.where(report).select("doc_id", "version", "kind", "start", "end")


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans), a row for each document: array of (start, rank, kind, end).

    Spans are sorted by start, then by kind as listed in BASE_KINDS and WEAK_KINDS;
    rank is a kind's place there. Offsets are code points, end exclusive. A null or
    empty text has none. Rows with the same id and text get the same spans each.

    Base spans are leftmost and do not overlap others of their kind; a match that
    is too short is passed over. Weak spans need their complement in the same scope,
    at any distance: an account name a secret; a mixed token an identifier or an
    endpoint; an endpoint both an identifier and a secret.
    """
    found = linked_parts(secret_parts(docs, doc_id, text))
    rank = F.coalesce(*[F.when(F.col("kind") == kind, n) for n, kind in enumerate([*BASE_KINDS, *WEAK_KINDS])])
    spans = found.groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans")
    ).select(F.col("doc_id").alias("span_doc"), F.col("version").alias("span_version"), "spans")
    rows = identified(docs, doc_id, text).drop("text")
    joined = rows.join(
        spans, rows["doc_id"].eqNullSafe(spans["span_doc"]) & (rows["version"] == spans["span_version"]), "left"
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    return joined.select("doc_id", F.coalesce("spans", none).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
