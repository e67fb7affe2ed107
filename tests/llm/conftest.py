import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_data import messy  # noqa: E402,F401
