"""The event feeds, as data.

Feeds differ only in topic, kind of payload, the fields they name, and which
summary column they add to. Everything else is one generic job.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from hourtally.functions import text

# Kinds of payload.
OBJECT = "object"  # the payload is a JSON object
JSON_TEXT = "json text"  # the payload is a string that holds JSON
STAMPED_TEXT = "stamped text"  # the payload is "<13 digits><separator><text>"


@dataclass(frozen=True)
class Feed:
    """One event feed.

    With ``amount_field`` the amount times ``rate`` is added to ``adds_to``. Without
    one, each record adds 1 to ``adds_to``, provided that ``match_field`` (if any)
    equals ``match_value``. Text feeds add 1 to ``matches_to`` when a keyword occurs.
    """

    name: str
    topic: str
    payload: str
    adds_to: str
    time_field: str | None = None
    amount_field: str | None = None
    rate: float = 1.0
    match_field: str | None = None
    match_value: str | None = None
    matches_to: str | None = None
    keywords: tuple[str, ...] = ()

    def but(self, **changes) -> Feed:
        """The same feed with other parameters."""
        return replace(self, **changes)


# Topic, field and category names as the publishers write them, and the
# rate from book sales to the currency of the report.
TOPIC_PREFIX = "use-case-"

GARMENT_SALES = Feed(
    name="garment_sales",
    topic="use-case-garment_sales",
    payload=OBJECT,
    time_field="SALES_DATE",
    amount_field="ORDER_VALUE",
    adds_to="sales",
)
BOOK_SALES = Feed(
    name="book_sales",
    topic="use-case-book_sales",
    payload=OBJECT,
    time_field="SALES_DATE",
    amount_field="ORDER_AMOUNT",
    rate=1.5,
    adds_to="sales",
)
WEB_CLICKS = Feed(
    name="webclicks",
    topic="use-case-webclicks",
    payload=JSON_TEXT,
    time_field="timestamp",
    match_field="eventCategory",
    match_value="firstPage",
    adds_to="web_hits",
)
TWEETS = Feed(
    name="tweets",
    topic="use-case-tweets",
    payload=STAMPED_TEXT,
    keywords=text.POSITIVE_WORDS,
    adds_to="tweets",
    matches_to="tweets_positive",
)

ALL_FEEDS = (GARMENT_SALES, BOOK_SALES, WEB_CLICKS, TWEETS)
