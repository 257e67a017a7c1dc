import uuid

import pytest

from ledger_sync.session import local_session

USERS_HEADER = "userid,name,contact,balance"
TXN_HEADER = "transactionid,userId,amount,type,date,status,method"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "ledger-sync-tests")
    yield session
    session.stop()


@pytest.fixture
def write_csv(tmp_path):
    """Write lines to a new CSV file below the test's folder; returns the path."""

    def write(*lines, name=None, end="\n"):
        path = tmp_path / (name or f"{uuid.uuid4().hex}.csv")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes("".join(line + end for line in lines).encode())
        return str(path)

    return write


@pytest.fixture
def users_csv(write_csv):
    return lambda *rows, **kw: write_csv(USERS_HEADER, *rows, **kw)


@pytest.fixture
def txns_csv(write_csv):
    """Transaction extracts have CRLF line ends."""
    return lambda *rows, **kw: write_csv(TXN_HEADER, *rows, end="\r\n", **kw)
