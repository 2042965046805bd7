"""Names the syncs go by."""

from __future__ import annotations

# Module labels and the tables they land in, in sync order.
MODULE_TABLES = {
    "Accounts": "Accounts",
    "Deals": "Deals",
    "Blocks": "Blocks",
    "Site Splits": "Site_Splits",
    "Revenue Recognition": "Revenue_Recognition",
    "Stage History": "DealHistory",
}
# The modules of a full refresh, and those it takes when none is found.
REFRESH_LABELS = (
    "Deals",
    "Blocks",
    "Site Splits",
    "Revenue Recognition",
    "Stage History",
    "Blocks_X_Deals",
    "Companies",
)
DEFAULT_MODULES = ("Deals", "Blocks", "Site_Splits", "Revenue_Recognition")
# Fixed value: an api name whose spelling is repaired in the table name.
REPAIRED_NAMES = {"SIte_Splits": "Site_Splits"}


def refresh_table(api_name: str, prefix: str = "raw_") -> str:
    """Table of a module in the full refresh."""
    for wrong, right in REPAIRED_NAMES.items():
        api_name = api_name.replace(wrong, right)
    return f"{prefix}{api_name}"
