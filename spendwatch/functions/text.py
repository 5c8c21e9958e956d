"""Alert text.  The templates are fixed values and must stay word for word."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendwatch.functions.columns import fmt_grouped, py_str

# Message templates and patterns -------------------------------
USER_ID_PATTERN = r"^U[A-Z0-9]{6,}$"
EMOJI_CRITICAL = ":rotating_light:"
EMOJI_OTHER = ":warning:"
HEADLINE = "{emoji} Cluster Cost Alert ({severity})"
GREETING_DM = "Hi <@{recipient}>, your"
GREETING_CHANNEL = "Hi team — cluster owned by {owner_tag}: their"
UNKNOWN_OWNER = "_unknown owner_"
BODY = ("{greeting} all-purpose compute cluster *{cluster_name}* "
        "is currently projected to cost *{dollars}/day*, "
        "which is *{percent}* greater than the workspace average.")
PLAIN = "{severity}: cluster {cluster_name} projected at {dollars}/day ({percent} above average)"
LINK = "https://{host}/compute/clusters/{cluster_id}"
# -----------------------------------------------------------------------------


def fill(template: str, **parts: Column) -> Column:
    """``str.format`` for columns: literal text between ``{name}`` slots."""
    out, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            out.append(F.lit(head))
        out.append(parts[name])
    if rest:
        out.append(F.lit(rest))
    return F.concat(*out)


def format_dollars(x: Column) -> Column:
    """``$1,234`` or ``?`` for NULL."""
    return F.when(x.isNull(), F.lit("?")).otherwise(F.concat(F.lit("$"), fmt_grouped(x, 0)))


def format_percent_above(projected: Column, mean: Column) -> Column:
    """PR23: percent above the raw mean; ``?`` unless mean > 0 and a non-zero
    projection exist."""
    ok = mean.isNotNull() & (mean > 0) & projected.isNotNull() & (projected != 0)
    pct = (projected - mean) / mean * 100.0
    return F.when(ok, F.concat(fmt_grouped(pct, 0), F.lit("%"))).otherwise(F.lit("?"))


def is_user_id(s: Column) -> Column:
    return F.coalesce(s.rlike(USER_ID_PATTERN), F.lit(False))


def greeting(recipient: Column, creator: Column, creator_user_id: Column) -> Column:
    """PR26."""
    owner_tag = (F.when(creator_user_id.isNotNull() & (creator_user_id != ""),
                        F.concat(F.lit("<@"), creator_user_id, F.lit(">")))
                 .when(creator.isNotNull(), F.concat(F.lit("`"), creator, F.lit("`")))
                 .otherwise(F.lit(UNKNOWN_OWNER)))
    return F.when(is_user_id(recipient), fill(GREETING_DM, recipient=recipient)) \
        .otherwise(fill(GREETING_CHANNEL, owner_tag=owner_tag))


def headline(severity: Column) -> Column:
    emoji = F.when(severity == "CRITICAL", EMOJI_CRITICAL).otherwise(EMOJI_OTHER)
    return fill(HEADLINE, emoji=emoji, severity=py_str(severity))
