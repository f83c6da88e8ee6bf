"""Where the tests find their tables (a module of its own: ``conftest`` names are not importable safely)."""

SF_SMALL = "/root/testdata/sf0.001"
