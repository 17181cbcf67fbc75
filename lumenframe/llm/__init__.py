"""Training-data operators on DataFrames of documents and pages.

Nothing outside this subpackage imports it; deleting it leaves the rest intact.
"""
