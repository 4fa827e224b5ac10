"""A small grammar of salary labels: a currency, a period, and bounds where both are known.

label   = amounts [" + " rider]; a rider's numbers don't count
amounts = amount separator amount | "up to" amount | "from" amount
amount  = number ["k"], thousands parted by commas; "k" after one of two amounts also holds for the other if that is below 1,000
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Salary(NamedTuple):
    low: float | None = None
    high: float | None = None
    currency: str | None = None
    period: str | None = None


#: Marks that name a currency where no Latin letter stands before them, codes, and words of periods.
MARKS = {"US$": "USD", "S$": "SGD", "HK$": "HKD", "A$": "AUD", "NZ$": "NZD", "฿": "THB", "บาท": "THB", "£": "GBP", "€": "EUR"}
CODES = ("SGD", "HKD", "THB", "AUD", "NZD", "USD", "GBP", "EUR", "MYR")
PERIODS = {
    "Annual": (r"p\.?\s?a\.?", r"per\s+annum", r"per\s+year", "annually", "yearly"),
    "Monthly": (r"p\.?\s?m\.?", r"per\s+month", "monthly", "ต่อเดือน"),
    "Hourly": (r"p\.?\s?h\.?", r"per\s+hour", "hourly"),
    "Weekly": (r"per\s+week", "weekly"),
    "Daily": (r"per\s+day", "daily"),
}
#: Below this, a number beside one in thousands is in thousands too.
SHORT = 1000

_AMOUNT = r"(\d[\d,]*(?:\.\d+)?)\s*([kK]\b)?"
_MARK = rf"\s*(?:{'|'.join(map(re.escape, [*MARKS, '$', 'RM', *CODES]))})?\s*"
_RANGE = re.compile(rf"{_AMOUNT}{_MARK}(?:[-–—~]|to){_MARK}{_AMOUNT}", re.IGNORECASE)
_PERIOD = {name: re.compile(rf"(?:^|[\s\d,.(])(?:{'|'.join(words)})(?:$|[\s,.;)])") for name, words in PERIODS.items()}


def currency(label: str, given: str | None) -> str | None:
    """The code that came with the label if it is known, else that of a mark, else the one code in it."""
    if (code := (given or "").strip().upper()) in CODES:
        return code
    for mark, code in [*((re.escape(m), c) for m, c in MARKS.items()), ("RM(?![A-Za-z])", "MYR")]:
        if re.search(rf"(?<![A-Za-z]){mark}", label):
            return code
    named = [c for c in CODES if re.search(rf"\b{c}\b", label, re.IGNORECASE)]
    return named[0] if len(named) == 1 else None


def bounds(amounts: str) -> tuple[float | None, float | None]:
    found = re.findall(_AMOUNT, amounts)
    if len(found) == 2 and (m := _RANGE.search(amounts)):
        found = [m.groups()[:2], m.groups()[2:]]
        thousands = any(k for _, k in found)
        low, high = (x * 1000 if k or (thousands and x < SHORT) else x for x, k in ((float(n.replace(",", "")), k) for n, k in found))
        return (low, high) if low <= high else (None, None)
    if len(found) == 1:
        value = float(found[0][0].replace(",", "")) * (1000 if found[0][1] else 1)
        words = amounts.lower()
        return (None, value) if re.search(r"\bup\s+to\b", words) else (value, None) if re.search(r"\bfrom\b", words) else (None, None)
    return None, None


def parse(label: str | None, given: str | None = None) -> Salary:
    """Bounds only with a currency and a period; an amount that is neither a rising range nor "up to" or "from" has none."""
    label = (label or "").strip()
    if not label:
        return Salary()
    code, words = currency(label, given), label.lower()
    period = next((name for name, pattern in _PERIOD.items() if pattern.search(words)), None)
    low, high = bounds(re.split(r"\s\+\s", label, maxsplit=1)[0]) if code and period else (None, None)
    return Salary(low, high, code, period)
