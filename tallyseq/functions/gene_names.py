"""Simplification of lists of gene names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that look like placeholders, non-coding or pseudo genes (whole names; case matters unless said).
PSEUDO_PATTERNS = (
    r"ENS[A-Z]*G\d{11}(\.\d+)?",
    r"Gm\d+[A-Za-z0-9]*",
    r".*Rik",
    r".*OS\d*",
    r".*-AS\d*",
    r"LINC\d+[A-Z]*",
    r"(AC|AL)\d{3,}(\.\d+)?",
    r"RP\d+-\d+(\.\d+)?",
    r"(?i:.*-ps\d*)",
    r"(?i:.*-rs\d*)",
    r"RNA\d+SP\d+",
    r".*\d+P",
)
#: Fixed value: a digit, P and digits mark a pseudo gene, but for these names.
P_TAIL = r".*\dP\d+"
P_TAIL_EXCEPTIONS = ("FOXP1", "FOXP2", "FOXP3", "FOXP4", "GBP1", "ZBP1", "GTPBP1", "SPP1", "DUSP1", "AKAP1", "TRAP1", "RAMP1")
#: Mitochondrial names; two names joined by a dash; endings of a family's members.
MITOCHONDRIAL = r"^(MT|mt)-"
READTHROUGH = r"^([A-Za-z0-9]+)-([A-Za-z0-9]+)$"
PARALOG_BASE = r"^(.*?)[a-z]{1,3}\d+(?:-ps)?$"
FAMILY_BASES = (r"^(.*?)(?:[a-z]{1,3}\d+|\d+[a-z]{1,2})(?:-ps)?$", r"^(.+\d)P\d+$")
LEAST_BASE = 4


def is_pseudo(name: Column) -> Column:
    listed = name.rlike("^(?:" + "|".join(PSEUDO_PATTERNS) + ")$")
    p_tail = name.rlike(f"^{P_TAIL}$") & ~name.isin(*P_TAIL_EXCEPTIONS)
    paralog = F.regexp_extract(name, PARALOG_BASE, 1).rlike(r"\d$")
    return ~name.rlike(MITOCHONDRIAL) & (listed | p_tail | paralog)


def simplify(names: Column) -> Column:
    """The informative names of an array, in first-seen order.

    A joined name goes if one of its parts is listed; a pseudo name goes if a real one is listed; if
    nothing would stay, all stay. Then a member of a family goes if the family's base stays.
    """
    every = F.array_distinct(F.filter(F.transform(names, lambda t: F.trim(t)), lambda t: t != ""))

    def informative(own: Column) -> Column:
        real = F.exists(own, lambda t: ~is_pseudo(t))
        listed_part = lambda t: F.array_contains(own, F.regexp_extract(t, READTHROUGH, 1)) | F.array_contains(own, F.regexp_extract(t, READTHROUGH, 2))
        kept = F.filter(own, lambda t: F.when(t.rlike(MITOCHONDRIAL), True).when(t.rlike(READTHROUGH), ~listed_part(t)).otherwise(~(real & is_pseudo(t))))
        return F.when(F.size(kept) > 0, kept).otherwise(own)

    def without_members(own: Column) -> Column:
        base_listed = lambda t, p: (F.length(F.regexp_extract(t, p, 1)) >= LEAST_BASE) & F.array_contains(own, F.regexp_extract(t, p, 1))
        return F.filter(own, lambda t: ~(base_listed(t, FAMILY_BASES[0]) | base_listed(t, FAMILY_BASES[1])))

    staged = F.element_at(F.transform(F.array(every), informative), 1)
    return F.element_at(F.transform(F.array(staged), without_members), 1)


#: Why a name goes.
PART_LISTED = "dropped: readthrough_component_present"
REAL_LISTED = "dropped: pseudo_like_with_real_symbols_present"
BASE_LISTED = "collapsed_into_base: base="


def audit(names: Column) -> Column:
    """The names that ``simplify`` drops, as structs (name, reason), in first-seen order."""
    own = F.array_distinct(F.filter(F.transform(names, lambda t: F.trim(t)), lambda t: t != ""))
    kept = simplify(names)

    def reason(t: Column) -> Column:
        base = lambda p: F.regexp_extract(t, p, 1)
        of_family = lambda p: (F.length(base(p)) >= LEAST_BASE) & F.array_contains(kept, base(p))
        part = F.array_contains(own, base(READTHROUGH)) | F.array_contains(own, base(READTHROUGH.replace("^([A-Za-z0-9]+)-([", "^[A-Za-z0-9]+-([")))
        first = t.rlike(READTHROUGH) & ~t.rlike(MITOCHONDRIAL) & part
        alike = ~t.rlike(READTHROUGH) & is_pseudo(t) & F.exists(own, lambda x: ~is_pseudo(x))
        family = F.coalesce(*[F.when(of_family(p), base(p)) for p in FAMILY_BASES])
        return F.when(first, PART_LISTED).when(alike, REAL_LISTED).otherwise(F.concat(F.lit(BASE_LISTED), family))

    dropped = F.filter(own, lambda t: ~F.array_contains(kept, t))
    return F.transform(dropped, lambda t: F.struct(t.alias("name"), reason(t).alias("reason")))
