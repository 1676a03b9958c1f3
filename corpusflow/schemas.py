"""Explicit schemas: nothing that this engine reads or writes is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


LONGS, FLOATS, STRINGS = T.ArrayType(T.LongType()), T.ArrayType(T.FloatType()), T.ArrayType(T.StringType())

# The field names of a catalogue file's entry and of its item metadata.
FILE_FIELDS = "bitrate btih crc32 format height length license md5 mtime name original rotation sha1 size source title track width private".split()
METADATA_FIELDS = (
    "Length addeddate adder aspect_ratio backup_location closed_captioning collection color contact coverage creator credits "
    "curation date description director duration format genre glob holder ia_orig__runtime identifier identifier-access "
    "identifier-ark imdb keywords language lcenseurl license licenseurl licensurl mediatype noarchivetorrent ocr "
    "omp-locally-produced omp-project own pbcore-genre pick ppi presenter producer publicdate publisher release_date repub_state "
    "resource runtime scanner segments series sound sponsor subject title tv-parental-guidelines updatedate updater "
    "upload_application uploader vimeo-height vimeo-id vimeo-n-entries vimeo-playlist vimeo-playlist-index vimeo-uploader "
    "vimeo-uploader-id vimeo-view-count vimeo-webpage-url vimeo-width year youtube-height youtube-id youtube-n-entries "
    "youtube-playlist youtube-playlist-index youtube-uploader youtube-uploader-id youtube-view-count youtube-webpage-url youtube-width"
).split()

CATALOGUE = T.StructType(
    [
        T.StructField("created", T.LongType()),
        T.StructField("d1", T.StringType()),
        T.StructField("d2", T.StringType()),
        T.StructField("dir", T.StringType()),
        T.StructField("files", T.ArrayType(strings(*FILE_FIELDS))),
        T.StructField("files_count", T.LongType()),
        T.StructField("identifier", T.StringType()),
        T.StructField("item_last_updated", T.LongType()),
        T.StructField("item_size", T.LongType()),
        T.StructField("metadata", strings(*METADATA_FIELDS)),
    ]
)
MAPPING = strings("identifier", "audio_document_id", "text_document_id")
ALIGNMENT = fields(start_ms=LONGS, end_ms=LONGS, label=STRINGS, cer=FLOATS, wer=FLOATS, hypotheses=STRINGS)
ALIGNMENTS = T.StructType([*MAPPING.fields, T.StructField("alignments", ALIGNMENT)])
MANIFEST = T.StructType([*MAPPING.fields, T.StructField("training_data", fields(duration_ms=LONGS, label=STRINGS, name=STRINGS))])
TRAINER_MANIFEST = fields(audio_filepath=T.StringType(), text=T.StringType(), duration=T.DoubleType(), shard_id=T.IntegerType())
TAR = fields(key=T.StringType(), value=T.BinaryType())
DATASET_CSV = strings("path", "caption", "metadata")
CTM = fields(utt=T.StringType(), channel=T.StringType(), start_ms=T.LongType(), end_ms=T.LongType(), word=T.StringType(), conf=T.DoubleType())
