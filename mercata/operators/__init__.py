"""DataFrame operators: dense keys and ranks (``keys``), size-checked lookups (``lookup``),
dimension / fact / mart builders (``dims``, ``facts``, ``marts``) and audits (``quality``)."""
