"""Text rules for customer data and fuzzy name matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted shape of an e-mail address.
EMAIL_SHAPE = r"(?i)^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# Accented Latin letters and the plain letters they fold to.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def clean_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def is_email(email: Column) -> Column:
    return email.rlike(EMAIL_SHAPE)


def format_tax_id(tax_id: Column) -> Column:
    """11 characters become XXX.XXX.XXX-XX; any other length gives NULL."""
    parts = [F.substring(tax_id, start, size) for start, size in ((1, 3), (4, 3), (7, 3), (10, 2))]
    shaped = F.concat(parts[0], F.lit("."), parts[1], F.lit("."), parts[2], F.lit("-"), parts[3])
    return F.when(F.length(tax_id) == 11, shaped)


def fold_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def trigrams(text: Column) -> Column:
    """Distinct three-letter pieces of each word, words padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(fold_accents(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    pieces = F.transform(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1),
            lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)),
        ),
    )
    return F.array_distinct(F.flatten(pieces))
