"""Whole plans: XML shredding, the vulnerability mart and patch catalog,
and the host exposure report."""
