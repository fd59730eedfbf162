"""Token files of all documents, written and read back."""

from faultlens.llm.registry import query, read
from faultlens.llm.token_files import read_tokens, write_tokens
from faultlens.session import run_dir


@query("op4_token_files")
def op4_token_files(spark, sf_dir):
    """Every document as read back from token files; null and empty texts are the end id alone."""
    path = run_dir(spark, "tokens")
    write_tokens(read(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, digest=True)
