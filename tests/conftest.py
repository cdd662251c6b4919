import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from caseloom.session import get_spark  # noqa: E402

MESSAGE = "\r".join([
    r"MSH|^~\&|LOOM|FX000009|AX_ECR|AX|20260310081500||ORU^R01|C1|P|2.5.1",
    "PID|1||abc123^^^FX000009^MR||ROE^PATIENT||19800229|F|||1 MILL RD^^Redthorn^AX^10001",
    "OBR|1||RQ1||PCR^Nucleic acid test^L||20260308",
    "OBX|1|CWE|990063002^RSV infection^LOC||POS^Positive^LOC|||A|||F|||20260310",
    r"NTE|1||Cough \T\ fever. Ratio 1\S\4.",
])


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def message():
    return MESSAGE
