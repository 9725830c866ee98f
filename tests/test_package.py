import subprocess
import sys

from vigil.session import package_zip


def test_the_archive_is_enough_to_import_the_workers_modules(tmp_path):
    path = package_zip(str(tmp_path))
    assert package_zip(str(tmp_path)) == path
    code = (f"import sys; sys.path.insert(0, {path!r}); import vigil.operators.contained, vigil.operators.towers, vigil.sources.payloads, "
            "vigil.plans.catalog as c; c.load_all(); assert len(c.QUERIES) > 60; assert '.zip' in vigil.__file__")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)
