"""Conforming rules, as jobs over whole tables made of column expressions."""

from postledger.functions.amount import amount, with_amounts
from postledger.functions.company import with_company
from postledger.functions.location import with_location
from postledger.functions.posted_date import posted_date, with_posted_date
from postledger.functions.text import fold_case, strip_blanks

__all__ = [
    "amount", "fold_case", "posted_date", "strip_blanks",
    "with_amounts", "with_company", "with_location", "with_posted_date",
]
