"""Writers: record files, field catalogues, embedding sets, collections and exports."""
