"""Part of the sievewright engine."""
