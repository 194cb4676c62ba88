"""Training-data operators: joins on shingles, token counts, archives, filters, scores, packing and mixing.

Nothing outside this subpackage imports it; ``queries.py`` lists what it registers.
"""
