"""Training-data operators: tokens, chats, near copies, packing, pages, secrets,
fingerprints, learned filters and vector search.

Nothing outside this subpackage imports it.  Every operator takes a DataFrame
and the names of the columns it reads and returns a DataFrame.
"""
