"""What tasks get must run on machines that have the third-party packages but not this library."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from acequia.llm import curve_packing, filter_audit, kneser_ney, merkle, minhash, mixing, registry, token_counts

FUNCTIONS = {
    "op4 locate": lambda: registry.partial(registry.public_file, registry.TOKENIZER),
    "op4": lambda: token_counts._frequencies(registry.partial(registry.public_file, registry.TOKENIZER)),
    "op12": lambda: curve_packing._tokenized(registry.partial(registry.public_file, registry.PACKING_TOKENIZER), 2, 1),
    "op12 cut": lambda: curve_packing._cut(10, 8, 2),
    "op11": lambda: merkle._folded(4, True),
    "op13": lambda: filter_audit._judged,
    "op1": lambda: kneser_ney.lean(kneser_ney._frequencies(3)),
    "op7": lambda: minhash.lean(minhash._signatures(4, 2, 2)),
    "op8": lambda: mixing.lean(mixing._classified(mixing.np.zeros((1, mixing.BUCKETS + 1)))),
}
RUN = ("op12", "op12 cut", "op13", "op8")  # those that need no task around them


@pytest.mark.parametrize("name", FUNCTIONS)
def test_functions_load_without_the_package(name, tmp_path):
    path = tmp_path / "f.pkl"
    path.write_bytes(cloudpickle.dumps(FUNCTIONS[name]()))
    code = (f"import pickle; f = pickle.load(open({str(path)!r}, 'rb'))\n"
            "import importlib.util; assert importlib.util.find_spec('acequia') is None\n"
            + ("print(f())" if name == "op4 locate" else "list(f(iter([])))" if name in RUN else ""))
    done = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr[-800:]
