import importlib.util
import sys
from pathlib import Path

# The brute-force versions live beside the tests that need them most.
_spec = importlib.util.spec_from_file_location("tests_llm_brute", Path(__file__).with_name("test_llm_operators.py"))
_module = importlib.util.module_from_spec(_spec)
sys.modules["tests_llm_brute"] = _module
_spec.loader.exec_module(_module)
