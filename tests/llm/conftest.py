import pytest

pytest.importorskip("tidefeed.llm")
