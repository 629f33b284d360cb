"""Writers: table exports and definition versions."""
