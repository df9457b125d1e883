"""Part of seqcal; see the README for what lies here."""
