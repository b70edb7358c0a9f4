"""The three-record mock source (two good records, one bad e-mail)."""

from __future__ import annotations

import json

# ---- fixed values: the mock batch -------------------------------------------------
MOCK_CONTACTS = [
    {"id": "contact_1", "properties": {"email": "test1@example.com", "firstname": "John",
                                       "lastname": "Doe", "createdate": "2024-01-15T10:30:00Z"}},
    {"id": "contact_2", "properties": {"email": "test2@example.com", "firstname": "Jane",
                                       "lastname": "Smith", "createdate": "2024-02-20T14:45:00Z"}},
    {"id": "contact_3", "properties": {"email": "invalid-email", "firstname": "Invalid",
                                       "lastname": "User"}},
]


def mock_page() -> str:
    """The mock batch as one API page document."""
    return json.dumps({"results": MOCK_CONTACTS, "paging": {}})


def write_mock_page(path: str) -> str:
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(mock_page())
    return path
